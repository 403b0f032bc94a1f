"""Document fingerprints: invertible Bloom lookup tables over paragraph digests.

A text is cut into paragraphs: at least `PARAGRAPH` characters, up to the next line or sentence
end, or if none is near up to a weaker mark of the text itself, or to 200 characters at most. The
last 300 characters, and so short texts, are cut into units of some words, the last 12 into pairs. The distinct 64-bit digests of its paragraphs go into a table of cells, each digest into one cell
of each of three parts; a cell holds a count, the xor of its digests and the xor of their
check sums. Subtracting the tables of two versions cancels what they share, and peeling
(a cell of one digest gives it away, which frees others) recovers the digests in which they differ. If that
fails because they differ in too many, both are built again with twice the cells and other
positions, until it succeeds. How far two versions differ is estimated first, from their smallest
digests, so that usually one table is built.

The fingerprint of a text is its smallest table as a string, so equal texts have equal
fingerprints; the likeness of two is the Jaccard index of their paragraph sets, known exactly from
the recovered differences.

Everything is column expressions on one row, so a pair of versions costs no shuffle.
Null text is an empty text; an empty text has no paragraphs, and two such are alike (1.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility_lake.llm.common import lanes

PARAGRAPH = 100
PART = 8  # cells in each of the three parts of the smallest table
SAMPLE = 64  # smallest digests of either set that tell how far two sets differ
ROOM = 1.6  # cells per digest in which they are thought to differ
LEVELS = 24  # doublings before a difference is read off the digests themselves
ROUNDS = 20  # of peeling in one table

# Ends of a paragraph, the stronger first; all are told by the text around them, so that versions meet again behind a change.
STOP = r"(?:\n|[.!?](?=\s)|[。！？])"
SOFT = r"(?:[,;:)}\]](?=\s)|[，；：、])"
MARK = r"(?:\s(?=[aeghknrtAEGHKNRT0369])|[的了是のはをに]|[aeost058](?=[bdgmnpr147])|[;{}])"
# (characters that must follow, least, most) of a paragraph: units are smaller where little text is left.
SIZES = ((300, PARAGRAPH, 200), (60, 30, 40), (12, 6, 8))


def _sized(left: int, least: int, most: int) -> str:
    ends = "|".join(f".{{{least},{most}}}?{end}" for end in (STOP, SOFT, MARK, r"\s"))
    return rf"(?=.{{{left}}})(?:{ends}|.{{{most}}})"


PARAGRAPHS = "(?s)" + "|".join(_sized(*size) for size in SIZES) + "|.{1,2}"


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text, sorted."""
    found = F.regexp_extract_all(text, F.lit(PARAGRAPHS), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(found, lambda p: F.xxhash64(p))))


def _bind(value: str, name: str, body: str) -> str:
    """`body` with a name for a value that it uses more than once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _check(digest: str) -> str:
    return f"int(xxhash64({digest}, 7L) & 2147483647L)"


_CELLS = "array<struct<cell: int, n: int, id: bigint, chk: int>>"
_EMPTY = f"cast(array() as {_CELLS})"


def _entries(digest_list: str, count: str, part: str, level: str) -> str:
    """What digests add to the cells: three entries each."""
    return (
        f"flatten(transform({digest_list}, x -> transform(array(0, 1, 2), j -> named_struct("
        f"'cell', int(j * {part} + pmod(xxhash64(x, {level}, j), {part})), 'n', {count}, 'id', x, 'chk', {_check('x')}))))"
    )


def _summed(entries: str) -> str:
    """Entries summed by cell, as the cells that are not empty, in order.

    Sorted entries of a cell are neighbours: each stretch between two changes of the cell is summed.
    """
    changes = "filter(sequence(0, size(q) - 1), i -> i = 0 or q[i].cell != q[i - 1].cell)"
    own = "slice(q, x + 1, coalesce(get(p, i + 1), size(q)) - x)"
    total = f"aggregate({own}, named_struct('cell', 0, 'n', 0, 'id', 0L, 'chk', 0), (a, e) -> named_struct("
    total += "'cell', e.cell, 'n', a.n + e.n, 'id', a.id ^ e.id, 'chk', a.chk ^ e.chk))"
    # A stretch of one entry is its own sum.
    each = f"transform(p, (x, i) -> if(coalesce(get(p, i + 1), size(q)) = x + 1, q[x], {total}))"
    some = f"filter({_bind(changes, 'p', each)}, k -> k.n != 0 or k.id != 0 or k.chk != 0)"
    return _bind(f"sort_array({entries})", "q", f"if(size(q) = 0, {_EMPTY}, {some})")


def table(digest_list: str, part: str, level: str) -> str:
    return _summed(_entries(digest_list, "1", part, level))


def _minus(left: str, right: str) -> str:
    """A table less another one."""
    negative = "k -> named_struct('cell', k.cell, 'n', -k.n, 'id', k.id, 'chk', k.chk)"
    return _summed(f"concat({left}, transform({right}, {negative}))")


def peeled(difference: str, part: str, level: str) -> str:
    """The recovered digests with their sign (1: left only, -1: right only), or null on failure."""

    def pure(sign: int) -> str:
        alone = f"filter(s.cells, k -> k.n = {sign} and k.chk = {_check('k.id')})"
        return f"array_distinct(transform({alone}, k -> k.id))"

    less = f"concat(s.cells, {_entries('up', '-1', part, level)}, {_entries('down', '1', part, level)})"
    freed = f"named_struct('cells', {_summed(less)}, 'left', concat(s.left, up), 'right', concat(s.right, down))"
    step = _bind(pure(1), "up", _bind(pure(-1), "down", f"if(size(up) + size(down) = 0, s, {freed})"))
    none = "cast(array() as array<bigint>)"
    start = f"named_struct('cells', {difference}, 'left', {none}, 'right', {none})"
    # A state that does not change any more costs one look at its cells per round.
    ended = f"aggregate(sequence(1, {ROUNDS}), {start}, (s, i) -> {step})"
    signed = ", ".join(
        f"transform(z.{side}, x -> named_struct('id', x, 'n', {n}))" for side, n in (("left", 1), ("right", -1))
    )
    return _bind(ended, "z", f"if(size(z.cells) = 0, concat({signed}), null)")


def apart(left: str, right: str) -> str:
    """About how many digests two sorted lists differ in: exact for lists of `SAMPLE` and fewer.

    The smallest digests of the union are a random sample of it; the share that both lists hold is
    their Jaccard index.
    """
    low, high = (f"slice({x}, 1, {SAMPLE})" for x in (left, right))
    shared = f"size(array_intersect(array_intersect({low}, {high}), u)) / double(greatest(1, size(u)))"
    far = f"(size({left}) + size({right})) * (1 - same) / (1 + same)"
    union = f"slice(array_sort(array_union({low}, {high})), 1, {SAMPLE})"
    return _bind(union, "u", _bind(shared, "same", far))


def differing(left: str, right: str, left_cells: str | None = None, right_cells: str | None = None) -> Column:
    """The digests in which two sorted digest columns differ, with their sign.

    `left_cells` and `right_cells` name columns with the smallest tables, to save building them.
    """
    first = peeled(
        _minus(left_cells or table(left, f"{PART}", "0"), right_cells or table(right, f"{PART}", "0")), f"{PART}", "0"
    )
    retry = peeled(_minus(table(left, "sz", "v"), table(right, "sz", "v")), "sz", "v")
    # The table is made for the estimated difference and grows if it still does not peel.
    part = f"int(ceil(({ROOM} * far + {PART}) / 3) * shiftleft(1, v - 1))"
    again = (
        f"aggregate(sequence(1, {LEVELS}), cast(null as array<struct<id: bigint, n: int>>), "
        f"(f, v) -> if(f is not null, f, {_bind(part, 'sz', retry)}))"
    )
    # The smallest table peels as a rule while it has 1.6 cells per difference or more.
    tables = _bind(apart(left, right), "far", f"coalesce(if({ROOM} * far <= {3 * PART}, {first}, null), {again})")
    plain = (
        f"concat(transform(array_except({left}, {right}), x -> named_struct('id', x, 'n', 1)), "
        f"transform(array_except({right}, {left}), x -> named_struct('id', x, 'n', -1)))"
    )
    return F.expr(f"coalesce({tables}, {plain})")


def likeness(left: str, right: str, difference: str) -> Column:
    both = F.size(left) + F.size(right)
    apart = F.size(difference)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - apart) / (both + apart))


def spelled(digest_list: str, cells: str) -> Column:
    """A table as text: the number of digests, then place, count, digests and check of every cell that is not empty."""
    return F.concat(
        F.size(digest_list).cast("string"),
        F.lit(":"),
        F.expr(
            f"array_join(transform({cells}, k -> concat("
            "lower(lpad(hex(bigint(k.cell)), 2, '0')), lower(lpad(hex(bigint(k.n)), 4, '0')), lower(lpad(hex(k.id), 16, '0')), "
            "lower(lpad(hex(bigint(k.chk)), 8, '0')))), '')"
        ),
    )


def smallest(digest_list: str) -> Column:
    return F.expr(table(digest_list, f"{PART}", "0"))


def with_next(docs: DataFrame, key: str, values: dict[str, Column], tie: Column) -> DataFrame:
    """`docs` with, as `next_<name>`, values of the row that follows in descending `key`; the first follows the last.

    Rows of equal key are ordered by `tie`; a null key comes last. The table is cut into ranges of
    the key at quantiles; each range is sorted on its own, and the first row of a range is also sent to
    the range before, behind its last row. Rows move once.
    """
    pieces = 4 * lanes(docs.sparkSession)
    quantiles = [i / pieces for i in range(1, pieces)]
    cuts = sorted(set(docs.approxQuantile(key, quantiles, 0.2 / pieces))) if pieces > 1 else []
    # Ranges are numbered upwards; the number is found by halving.
    steps = max(1, len(cuts).bit_length())
    # Quantiles are doubles; any whole number near one will do.
    cuts = [min(max(int(c), -(2**63)), 2**63 - 1) for c in cuts]
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.expr("cast(array() as array<bigint>)")
    number = F.expr(
        f"aggregate(sequence({steps - 1}, 0, -1), 0, (lo, b) -> if(lo + shiftleft(1, b) <= {len(cuts)} "
        f"and coalesce(get(_cuts, lo + int(shiftleft(1, b)) - 1) <= {key}, false), lo + int(shiftleft(1, b)), lo))"
    )
    placed = docs.withColumn("_cuts", bounds).withColumn("_range", number).drop("_cuts")
    # One row per range: a number that follows from the session's partitions, not from the input.
    firsts = placed.groupBy("_range").agg(F.max(key).alias("first")).orderBy("_range").collect()
    above = {r["_range"]: firsts[(i + 1) % len(firsts)]["_range"] for i, r in enumerate(firsts)}
    heads = F.create_map(*(F.lit(x) for r in firsts for x in (r["_range"], r["first"]))) if firsts else None
    if heads is None:
        return docs.select("*", *(c.alias(f"next_{n}") for n, c in values.items()))
    to = F.create_map(*(F.lit(x) for pair in above.items() for x in pair))
    copies = F.when(
        F.col(key).eqNullSafe(heads[F.col("_range")]),
        F.array(
            F.struct(F.col("_range").alias("at"), F.lit(False).alias("copy")),
            F.struct(to[F.col("_range")].alias("at"), F.lit(True).alias("copy")),
        ),
    ).otherwise(F.array(F.struct(F.col("_range").alias("at"), F.lit(False).alias("copy"))))
    sent = placed.withColumns({f"_next_{n}": c for n, c in values.items()}).withColumn("_tie", tie)
    sent = sent.withColumn("_sent", F.explode(copies))
    order = Window.partitionBy("_sent.at").orderBy("_sent.copy", F.col(key).desc_nulls_last(), "_tie")
    followed = sent.withColumns({f"next_{n}": F.lead(f"_next_{n}").over(order) for n in values})
    return followed.filter(~F.col("_sent.copy")).drop("_sent", "_tie", "_range", *(f"_next_{n}" for n in values))
