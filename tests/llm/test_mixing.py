import hashlib
import re

from pyspark.sql import functions as F

from locusweave.llm import mixing


def reshared(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        part = {s: left * weight[s] / total for s in free}
        left = 0.0
        for s in list(free):
            target[s] += part[s]
            if target[s] >= repeats * sizes[s]:
                left += target[s] - repeats * sizes[s]
                target[s] = float(repeats * sizes[s])
                free.discard(s)
    return target


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, size string, virtual_finish int")
    got = mixing.mixed_stream(mixing.sized(docs).withColumn("virtual_finish", F.lit("x"))).collect()
    sizes = {}
    for _, source, text, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken = reshared(sizes), dict.fromkeys(sizes, 0)
    for r in got:
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = {}
    for r in got:
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(1, largest[s]), s
    if len({(d, t) for d, _, t, *_ in rows}) == len(rows):
        assert sum(taken.values()) == int(1.5 * sum(sizes.values()))
        assert {r["doc_id"]: r["taken"] for r in got} == brute(rows, want, sizes)
    assert len(got) == len(rows)
    return got


def brute(rows, target, sizes):
    """The stream of all copies by virtual finish time, cut at the budget."""
    key = lambda s: "null" if s is None else "=" + s
    docs = []
    for d, source, text, *_ in rows:
        shuffle = hashlib.md5(f"{mixing.SEED}:{'null' if d is None else d}:{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()
        docs.append((shuffle, len(re.findall(r"[^\x20\x09-\x0D]+", text or "")), d, source))
    before, copies, taken = dict.fromkeys(sizes, 0), [], {d: 0 for d, *_ in rows}
    for shuffle, size, d, source in sorted(docs, key=lambda x: x[:2]):
        before[source] += size
        copies += [((before[source] + e * sizes[source]) / target[source], shuffle, key(source), size, d) for e in (0, 1) if size]
    left = int(1.5 * sum(sizes.values()))
    for *_, size, d in sorted(copies):
        taken[d] += min(size, left)
        left -= min(size, left)
    return taken


def test_targets_and_taken_follow_resharing(spark):
    rows = [(i, f"s{i % 7}" if i % 11 else None, "w " * (1 + i * i % 37), "x", 1) for i in range(400)]
    rows += [(1000 + i, "s0", "w " * 200, "x", 1) for i in range(50)]
    first = check(spark, rows)
    again = check(spark, rows[::-1])
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, first)) == sorted(map(key, again))


def test_small_and_odd_tables(spark):
    check(spark, [(1, "a", "one two", None, None)])
    check(spark, [(1, None, None, None, None), (1, None, None, None, None), (None, "a", "", None, None), (None, "a", "x y", None, None)])
    check(spark, [(5, "a", "x y z", None, None)] * 6 + [(6, "\U0001f600", "q " * 1000, None, None)])
    check(spark, [])


def test_rows_without_an_id_do_not_share_a_place(spark):
    rows = [(None, "a", f"word{i} " * 3, None, None) for i in range(50)]
    docs = mixing.sized(spark.createDataFrame(rows, "doc_id long, source string, text string, a string, b string"))
    assert docs.select("shuffle").distinct().count() == 50


def test_no_python_in_the_plan(spark):
    docs = mixing.sized(spark.createDataFrame([(1, "a", "x y")], "doc_id long, source string, text string"))
    plan = mixing.mixed_stream(docs)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
