import hashlib

from docweave.llm import lines as L
from llm.conftest import EDGE_TEXTS
from llm.test_pipeline import drop_lines


def brute(rows):
    known = [(d, t or "") for d, t in rows]
    counted = [i for i, (d, _) in enumerate(known) if d is not None]
    kept = dict(zip(counted, drop_lines([known[i] for i in counted])))
    out = []
    for i, (doc, text) in enumerate(known):
        left = kept[i][1] if doc is not None else text
        n = len(text.split("\n"))
        dropped = _dropped(known, i)
        out.append((doc, n, dropped, hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def _key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def _dropped(rows, i):
    doc, text = rows[i]
    if doc is None:
        return 0
    count = 0
    for line in text.split("\n"):
        holders = {d for d, t in rows if d is not None and len(_key(line)) >= 20 and _key(line) in map(_key, t.split("\n"))}
        count += len(holders) >= 3 and max(holders) != doc
    return count


def found(df):
    return sorted((tuple(r) for r in L.line_dedup_digest(df).collect()), key=str)


def corpus():
    shared = ["  This line is shared by MANY documents ", "short", "ünïcode línes of twenty chars", "x" * 19, "y" * 20]
    rows = []
    for i in range(40):
        own = [f"an own line of document number {i}", "", "\t"]
        rows.append((i * 7 % 41, "\n".join(own + [s.upper() if i % 3 == 0 else s for j, s in enumerate(shared) if (i + j) % 3])))
    rows += [(50, shared[0] + "\n" + shared[0].lower().strip()), (51, shared[0]), (51, shared[0])]
    return rows


def test_agrees_with_brute_force_for_any_batches(docs, monkeypatch):
    rows = corpus()
    expected = brute(rows)
    assert found(docs(rows)) == expected
    for batches, fanout in ((1, 2), (7, 2), (5, 10)):
        slim = docs(rows).select("doc_id", "text")
        got = L.dedup_lines(slim, batches=batches, fanout=fanout).collect()
        assert sorted((r["doc_id"], r["_n_lines"], r["_n_dropped"]) for r in got) == sorted(e[:3] for e in expected)


def test_runs_are_levelled(spark):
    runs = L.LineRuns(spark, fanout=3)
    for i in range(10):
        runs.add(spark.createDataFrame([(100 - i, h, h) for h in range(5)], "doc_id long, h1 long, h2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    # keys that are decided are not stored again
    assert sum(r["n_docs"] for run in runs.runs() for r in run.plain.collect()) < 50
    assert {r["keep"] for r in runs.repeated().collect()} == {100}


def test_runs_in_any_order_of_batches(spark):
    for order in (range(6), range(5, -1, -1), (3, 0, 5, 1, 4, 2)):
        runs = L.LineRuns(spark, fanout=2)
        for i in order:
            runs.add(spark.createDataFrame([(i, 1, 1), (i, i % 2 + 2, 0)], "doc_id long, h1 long, h2 long"))
        assert sorted(tuple(r) for r in runs.repeated().collect()) == [(1, 1, 5), (2, 0, 4), (3, 0, 5)]


def test_edge_rows_empty_table_and_clashing_names(docs):
    line = "a line that is long enough to count"
    rows = [*enumerate(EDGE_TEXTS), (None, line), (60, line), (61, line), (62, line)]
    assert found(docs(rows)) == brute(rows)
    assert found(docs([])) == []
    df = docs(rows).withColumnRenamed("n_chars", "keep").withColumnRenamed("lang", "h1")
    assert L.dedup_lines(df).columns == [*df.columns, "_n_lines", "_n_dropped"]


def test_texts_of_very_many_repeated_lines(docs):
    import time

    seconds = []
    for n in (10_000, 80_000):
        text = "\n".join(f"a line that is repeated in all of them {i}" for i in range(n))
        started = time.perf_counter()
        got = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in L.line_dedup_digest(docs([(i, text) for i in range(3)])).collect()}
        seconds.append(time.perf_counter() - started)
        assert got == {0: (n, n), 1: (n, n), 2: (n, 0)}
    assert seconds[1] < 8 * seconds[0]
