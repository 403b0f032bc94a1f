"""Tables that grow by runs: every write adds a folder, and folders are merged by levels.

A pointer (see `versions`) lists the live runs, so a write, a merge or the replacement of a run shows
in one step. A level that has `fan` runs is merged into one run of the next level: with n
writes there are at most fan * log(n) / log(fan) runs, and a row is rewritten once per level.

A run carries the id of the micro-batch that wrote it. A retried micro-batch replaces its run; if it
was merged meanwhile its rows are in already and it adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from mobility_lake.sources import versions

FAN = 8


@dataclass(frozen=True)
class Run:
    """A live run: its folder's name, its level, the last batch in it, and what its table notes of it."""

    name: str
    level: int
    batch: int
    notes: dict = field(default_factory=dict)


def _runs(state: dict | None) -> list[Run]:
    return [Run(**run) for run in (state or {}).get("runs", [])]


def _state(runs: Sequence[Run], through: int | None) -> dict:
    return {"runs": [asdict(run) for run in runs], "through": through}


def live(spark: SparkSession, path: str) -> list[Run]:
    """The runs that make up the table now."""
    return _runs(versions.state(spark, path))


def folders(path: str, runs: Sequence[Run], inside: str = "") -> list[str]:
    """Where their files are."""
    return [versions.folder(path, run.name) + (f"/{inside}" if inside else "") for run in runs]


def _is_merged(state: dict | None, batch: int) -> bool:
    through = (state or {}).get("through")
    own = [run for run in _runs(state) if run.level == 0 and run.batch == batch]
    return through is not None and batch <= through and not own


def add(spark: SparkSession, path: str, batch: int, write: Callable[[str], dict | None]) -> bool:
    """Have `write` fill a folder and count it in as the run of a batch; it returns the notes.

    False if the batch is part of a merged run, so that nothing was to be done.
    """
    if _is_merged(versions.state(spark, path), batch):
        return False
    name, place = versions.new_folder(path, f"batch{batch}")
    run = Run(name, 0, batch, write(place) or {})

    def change(state: dict | None) -> dict:
        others = [r for r in _runs(state) if r.level > 0 or r.batch != batch]
        through = (state or {}).get("through")
        return _state(others if _is_merged(state, batch) else [*others, run], through)

    versions.commit(spark, path, change)
    return True


def replace_all(spark: SparkSession, path: str, batch: int, write: Callable[[str], dict | None]) -> None:
    """Make one run the whole table, as if all batches so far were merged into it."""
    name, place = versions.new_folder(path, "all")
    run = Run(name, 1, batch, write(place) or {})
    versions.commit(spark, path, lambda state: _state([run], (state or {}).get("through")))


def merge(
    spark: SparkSession,
    path: str,
    write: Callable[[Sequence[Run], str], dict | None],
    before: int | None = None,
    fan: int = FAN,
) -> int:
    """Merge every level that has `fan` runs; only batches below `before` take part, if it is given.

    `write` combines runs into a folder. If a batch was written anew while it did, the merge is left
    to the next call. Returns how many merges there were.
    """
    done = 0
    while True:
        runs = [run for run in live(spark, path) if before is None or run.batch < before]
        levels = sorted({run.level for run in runs})
        full = [level for level in levels if sum(run.level == level for run in runs) >= fan]
        if not full or not _merge_once(spark, path, [run for run in runs if run.level == full[0]], write):
            return done
        done += 1


def _merge_once(
    spark: SparkSession, path: str, chosen: Sequence[Run], write: Callable[[Sequence[Run], str], dict | None]
) -> bool:
    name, place = versions.new_folder(path, f"level{chosen[0].level + 1}")
    merged = Run(name, chosen[0].level + 1, max(run.batch for run in chosen), write(chosen, place) or {})
    names = {run.name for run in chosen}

    def change(state: dict | None) -> dict:
        now, through = _runs(state), (state or {}).get("through")
        if not names <= {run.name for run in now}:
            return _state(now, through)
        rest = [run for run in now if run.name not in names]
        return _state([*rest, merged], max(merged.batch, -1 if through is None else through))

    return any(run["name"] == name for run in versions.commit(spark, path, change)["runs"])
