import itertools

from hypothesis import given
from hypothesis import strategies as st

from mobility_lake.llm import reply_trees as rt

SCHEMA = "tree long, id long, parent long, role string, text string, score double, formatted string"
PARTS = st.lists(st.sampled_from(["<|", "|>", "\n", "\\", "<", "|", "end", "a", "<|end|>\n", "é"])).map("".join)


@given(st.lists(st.tuples(PARTS, PARTS)))
def test_any_turns_read_back(turns):
    formatted, spans = rt.format_turns(turns, learned="a")
    assert rt.read_turns(formatted) == turns
    assert [rt.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "a"]


def found(spark, rows, **options):
    messages = spark.createDataFrame([(*r, "old") for r in rows], SCHEMA)
    return rt.conversations(messages, "tree", "id", "parent", "role", "text", "score", **options).collect()


def brute(rows):
    """Sorted texts of root-to-leaf paths by tree."""
    by = {(r[0], r[1]): r for r in rows}
    above = {(r[0], r[2]) for r in rows if r[2] != r[1]}
    out = []
    for key, row in by.items():
        if key in above:
            continue
        path, seen = [row], {key}
        while path[-1][2] is not None and path[-1][2] != path[-1][1] and (path[-1][0], path[-1][2]) in by:
            nxt = by[path[-1][0], path[-1][2]]
            if (nxt[0], nxt[1]) in seen:
                path = None
                break
            seen.add((nxt[0], nxt[1]))
            path.append(nxt)
        if path:
            out.append((row[0], row[1], [(r[3] or "", r[4] or "") for r in reversed(path)]))
    return sorted(out, key=repr)


def test_paths_of_trees(spark):
    rows = [(1, 0, None, "user", "root", 0.0)]
    rows += [(1, i, (i - 1) // 2, "assistant" if i % 2 else "user", f"m{i}", float(i % 3)) for i in range(1, 30)]
    rows += [(2, i, i - 1 if i else None, "user", f"chain{i}", 1.0) for i in range(70)]
    rows += [(3, 5, 99, "user", "orphan", None), (3, 6, 6, None, None, 1.0), (None, 1, None, "user", "no tree", 1.0), (None, 2, 1, "assistant", "x", 1.0)]
    rows += [(4, 1, 2, "user", "cycle", 1.0), (4, 2, 1, "user", "cycle", 1.0), (4, 3, 1, "user", "below a cycle", 1.0)]
    got = sorted(((r["tree"], r["leaf"], rt.read_turns(r["formatted"])) for r in found(spark, rows)), key=repr)
    assert got == brute(rows)


def test_ranks_and_best_branches(spark):
    rows = [(1, 0, None, "user", "q", 0.0)] + [(1, i, 0, "assistant", f"a{i}", s) for i, s in ((1, 1.0), (2, 3.0), (3, 3.0), (4, None))]
    ranks = {r["leaf"]: r["rank"] for r in found(spark, rows)}
    assert ranks == {2: 1, 3: 2, 1: 3, 4: 4}
    assert sorted(r["leaf"] for r in found(spark, rows, branches=2)) == [2, 3]


def test_repeated_and_no_messages(spark):
    rows = [(1, 0, None, "user", "b", 0.0), (1, 0, None, "user", "a", 0.0), (1, 0, None, "user", "a", 0.0)]
    assert [rt.read_turns(r["formatted"]) for r in found(spark, rows)] == [[("user", "a")]]
    assert found(spark, []) == []
    assert list(itertools.chain(rt.read_turns(""))) == []
