"""Urban-mobility lake on PySpark: feeds to Parquet tables, hourly rollups, daily marts."""
