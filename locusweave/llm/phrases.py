"""Phrase collocations per language: frequent runs of 2 to 4 words, counted by tries over all text positions at once, and scored by their weakest cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import trie
from .arrays import opened, ship
from .common import materialise, table
from .hashing import BASE, mix64

#: Fixed by the operator's contract.
LEAST, LONGEST, FACTOR, SHARE, MOST = 30, 4, 2_000_000, 80, 2000
UNKNOWN_LANG = "und"
#: Phrases of one trie, which a task maps; more phrases make more tries, dealt by their first words.
SLICE = 2_000_000
#: Bytes of text that are worked on at once, and numbers that are sorted at once.
SLAB, BLOCK = 1 << 20, 1 << 22
#: Words that are told apart at once; their texts are held meanwhile.
WORD_BLOCK = 1 << 20

#: Small letters for capitals, a space for a tab, a line feed for each character that ends a piece.
_PLAIN = bytearray(range(256))
_PLAIN[65:91] = range(97, 123)
_PLAIN[9] = 32
for _c in b".,;:!?\x0a\x0b\x0c\x0d":
    _PLAIN[_c] = 10
_PLAIN = bytes(_PLAIN)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


class Words:
    """The words of some texts in order: key (64 bits of word and language), whether a piece ends behind it, and its bytes."""

    def __init__(self, texts: list[bytes], langs: np.ndarray):
        data = np.frombuffer(b"\n".join([*texts, b""]).translate(_PLAIN), np.uint8)
        inside = (data != 32) & (data != 10)
        edge = np.diff(inside.astype(np.int8), prepend=0)
        self.data, self.starts = data, np.flatnonzero(edge == 1)
        self.ends = np.flatnonzero(edge == -1)  # the last byte is a line feed
        n = len(self.starts)
        marks = np.cumsum(data == 10, dtype=np.int64)
        self.last = np.ones(n, bool)
        self.last[:-1] = marks[self.starts[1:]] != marks[self.ends[:-1] - 1]
        size = self.ends - self.starts
        at = np.cumsum(size) - size
        with np.errstate(over="ignore"):
            powers = np.full(int(size.max(initial=0)) + 1, BASE, np.uint64)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            place = np.arange(int(size.sum())) - np.repeat(at, size)
            value = _BYTE[data[inside]] * powers[place]
            total = np.add.reduceat(value, at) if n else np.zeros(0, np.uint64)
            offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
            self.lang = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(self.starts, offsets)))
            key = mix64(total + size.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
            self.key = mix64(key + langs[self.lang]) if n else key


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Whole texts, about SLAB bytes at a time, with each one's language. A longer text is a slab by itself: no phrase is cut."""
    hashes: dict[str, int] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        run, names, size = [], [], 0
        for lang, value in zip(langs, batch.column("text"), strict=True):
            text = b"" if not value.is_valid else value.as_buffer().to_pybytes()
            if run and size + len(text) > SLAB:
                yield Words(run, np.array([hashes[x] for x in names], np.uint64)), names
                run, names, size = [], [], 0
            if lang not in hashes:
                hashes[lang] = xxhash.xxh64_intdigest(lang.encode())
            run.append(text)
            names.append(lang)
            size += len(text)
        if run:
            yield Words(run, np.array([hashes[x] for x in names], np.uint64)), names


class _Counts:
    """Counts numbers a block at a time."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, *columns: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size >= BLOCK:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[np.ndarray, ...]]:
        if self.size:
            columns = [np.concatenate(c) for c in zip(*self.parts, strict=True)]
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            new = np.ones(self.size, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            at = np.flatnonzero(new)
            yield (*(c[at] for c in columns), np.diff(np.append(at, self.size)))
        self.parts, self.size = [], 0


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for k, v in columns.items()})


def _texts(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """data[start : start + size] of each, as one array of strings; whole words are valid UTF-8 if the text is."""
    ends = np.cumsum(sizes)
    flat = data[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(flat))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, names, parts, size = {}, [], [], 0

    def flush():
        data, keys, langs, starts, sizes = (np.concatenate(c) for c in zip(*parts, strict=True))
        starts = starts + np.repeat(np.cumsum([0, *(len(p[0]) for p in parts[:-1])]), [len(p[1]) for p in parts])
        key, first, n = np.unique(keys, return_index=True, return_counts=True)
        yield _rows(lang=pa.array(names).take(pa.array(langs[first])), key=key, word=_texts(data, starts[first], sizes[first]), n=n)

    for words, langs in _slabs(batches):
        for name in langs:
            if name not in codes:
                codes[name] = len(names)
                names.append(name)
        if len(words.key):
            parts.append((words.data, words.key, np.array([codes[x] for x in langs], np.int32)[words.lang], words.starts, words.ends - words.starts))
            size += len(words.key)
        if size >= WORD_BLOCK:
            yield from flush()
            parts, size = [], 0
    if size:
        yield from flush()


def _numbers(words: Words, known: np.ndarray) -> np.ndarray:
    """Each word's place among the known keys, -1 for others."""
    if not len(known):
        return np.full(len(words.key), -1, np.int64)
    at = np.minimum(np.searchsorted(known, words.key), len(known) - 1)
    return np.where(known[at] == words.key, at, -1)


def _pairs(names: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = opened(names)["known"], _Counts()
        for words, _ in _slabs(batches):
            w = _numbers(words, known)
            at = np.flatnonzero((w[:-1] >= 0) & (w[1:] >= 0) & ~words.last[:-1])
            for p, n in counts.add(w[at] << 32 | w[at + 1]):
                yield _rows(p=p, n=n)
        for p, n in counts.flush():
            yield _rows(p=p, n=n)

    return run


def _longer(names: dict[str, str], tries: list[dict[str, str]]):
    """Runs of three and four words all of whose pairs are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = opened(names)["known"], _Counts()
        got, digits = [opened(t) for t in tries], trie.digits_of(len(known))
        for words, _ in _slabs(batches):
            w = _numbers(words, known)
            at = np.flatnonzero((w[:-1] >= 0) & (w[1:] >= 0) & ~words.last[:-1])
            pair = np.zeros(len(w) + 2, bool)
            for t in got:
                alive, _ = trie.step(t, w[at], w[at + 1], digits)
                pair[at[alive]] = True
            three = np.flatnonzero(pair[:-1] & pair[1:])
            four = three[pair[three + 2]]
            p = np.concatenate([w[three] << 32 | w[three + 1], w[four] << 32 | w[four + 1]])
            q = np.concatenate([w[three + 2] + 1 << 32, w[four + 2] + 1 << 32 | w[four + 3] + 1])
            for a, b, n in counts.add(p, q):
                yield _rows(p=a, q=b, n=n)
        for a, b, n in counts.flush():
            yield _rows(p=a, q=b, n=n)

    return run


#: Stands for the second number of what is a single word.
WORD = -1
#: Phrases whose sums travel in one row, and rows of one phrase range that a task adds up at once.
RANGE, FAN = 1 << 16, 64


def _count(names: dict[str, str], tries: list[dict[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened(names)["known"]
        got, digits = [opened(t) for t in tries], trie.digits_of(len(known))
        totals = [np.zeros(len(t["p"]), np.int64) for t in got]
        for words, _ in _slabs(batches):
            w = _numbers(words, known)
            begin = np.flatnonzero(w >= 0)
            for t, total in zip(got, totals, strict=True):
                at, states = begin, w[begin]
                for level in range(1, LONGEST):
                    on = at + level < len(w)
                    at, states = at[on], states[on]
                    on = (w[at + level] >= 0) & ~words.last[at + level - 1]
                    at, states = at[on], states[on]
                    alive, states = trie.step(t, states, w[at + level], digits)
                    at = at[alive]
                    ended = t["accept"][states]
                    total += np.bincount(ended[ended >= 0], minlength=len(total))
        task = TaskContext.get().partitionId()
        for k, total in enumerate(totals):
            for r in range(-(-len(total) // RANGE)):
                yield from _sums(task, k, r, total[r * RANGE : (r + 1) * RANGE])

    return run


def _sums(task: int, k: int, r: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sums of one range of a trie's phrases as one row, without those that are 0."""
    at = np.flatnonzero(total)
    if len(at):
        yield pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "trie": pa.array([k], pa.int32()), "range": pa.array([r], pa.int32()), "at": [at.astype(np.uint16).tobytes()], "n": [total[at].tobytes()]})


_SUMS = "task int, trie int, range int, at binary, n binary"


def _added(key: tuple, rows: pa.Table) -> pa.Table:
    total = np.zeros(RANGE, np.int64)
    for at, n in zip(rows.column("at").to_pylist(), rows.column("n").to_pylist(), strict=True):
        total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int64)
    return pa.Table.from_batches(_sums(*(k.as_py() for k in key), total))


def _add_up(counted: DataFrame) -> DataFrame:
    """Sums of tasks to one row a range: FAN rows at a time, so that no task holds all of a range's however many tasks there were."""
    tasks = (counted.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        counted = counted.withColumn("task", F.floor(F.col("task") / FAN).cast("int")).groupBy("task", "trie", "range").applyInArrow(_added, _SUMS)
        tasks = -(-tasks // FAN)
        if tasks == 1:
            return counted


def _spell(tries: list[dict[str, str]]):
    """Rows of sums to a row a phrase: its two numbers, its count, and its words' numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [opened(t) for t in tries]
        for batch in batches:
            for k, r, at, n in zip(*(batch.column(c).to_pylist() for c in ("trie", "range", "at", "n")), strict=True):
                at, n = np.frombuffer(at, np.uint16).astype(np.int64) + r * RANGE, np.frombuffer(n, np.int64)
                p, q = got[k]["p"][at], got[k]["q"][at]
                ids = _columns(p, q)
                has, ends = ids >= 0, np.append(0, np.cumsum((ids >= 0).sum(1))).astype(np.int32)
                yield _rows(p=p, q=q, a=n, ids=pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[has])))

    return run


def _number(names: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = opened(names)["known"]
        for batch in batches:
            at = np.searchsorted(known, batch.column("key").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_pydict({"id": pa.array(at)} | {c: batch.column(c) for c in ("lang", "word", "f")})

    return run


def _columns(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Phrases in two numbers, as rows of word numbers."""
    return np.stack([p >> 32, p & 0xFFFFFFFF, (q >> 32) - 1, (q & 0xFFFFFFFF) - 1], 1)


def _tries(phrases: DataFrame, words: int, what: str) -> list[dict[str, str]]:
    """Tries of at most about SLICE phrases (p, q), made one after another, so that the driver holds one slice."""
    slices, out = -(-phrases.count() // SLICE), []
    for k in range(slices):
        mine = phrases if slices == 1 else phrases.where(F.pmod(F.xxhash64(F.shiftright("p", 32)), F.lit(slices)) == k)
        got = mine.select("p", "q").toArrow()
        p, q = (got.column(c).to_numpy() for c in ("p", "q"))
        rows = _columns(p, q)
        arrays = trie.build(rows, words)
        out.append(ship(phrases.sparkSession, f"{what}-{k}", arrays | {"p": p, "q": q}))
    return out


def _part(ids: Column, first: Column | int, size: Column | int) -> tuple[Column, Column]:
    """Part of a phrase in the two numbers that name it; a word is its number and WORD."""
    part = F.slice(ids, F.lit(first) if isinstance(first, int) else first, F.lit(size) if isinstance(size, int) else size)
    w = lambda k: F.coalesce(F.try_element_at(part, F.lit(k)), F.lit(-1)).cast("long")
    one = F.size(part) == 1
    p = F.when(one, w(1)).otherwise(F.shiftleft(w(1), 32).bitwiseOR(w(2)))
    return p, F.when(one, F.lit(WORD).cast("long")).otherwise(F.shiftleft(w(3) + 1, 32).bitwiseOR(w(4) + 1))


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Totals (lang, n); frequent words (id, lang, word, f); candidates (p, q, a, ids).

    Four passes over the texts. The first counts words. The second counts pairs of words that are frequent both, the third runs of
    three and four all of whose pairs are: what occurs less than `least` times is no candidate, since a longer phrase is never more
    frequent than its parts. Candidates go into double-array tries, at most SLICE phrases each, which every executor maps;
    in the fourth pass each task advances the states of all positions of its texts word by word and adds up the accepting ones, and
    the tasks' sums are added. Numbers of words and phrases, not texts, are shuffled.
    """
    spark = docs.sparkSession
    texts = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"))
    words = texts.mapInArrow(_words, "lang string, key long, word string, n long").groupBy("lang", "key", "word").agg(F.sum("n").alias("f"))
    words = materialise(words, "words")
    frequent = words.where(F.col("f") >= least)
    known = np.unique(frequent.select("key").toArrow().column("key").to_numpy().view(np.uint64))
    names = ship(spark, "words", {"known": known})
    pairs = texts.mapInArrow(_pairs(names), "p long, n long").groupBy("p").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    pairs = materialise(pairs.select("p", F.lit(0).cast("long").alias("q")), "pairs")
    longer = texts.mapInArrow(_longer(names, _tries(pairs, len(known), "pair-trie")), "p long, q long, n long")
    longer = longer.groupBy("p", "q").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("p", "q")
    candidates = materialise(pairs.unionByName(longer), "candidates")
    tries = _tries(candidates, len(known), "trie")
    counted = _add_up(materialise(texts.mapInArrow(_count(names, tries), _SUMS), "counts"))
    sums = materialise(counted.mapInArrow(_spell(tries), "p long, q long, a long, ids array<long>").where(F.col("a") >= least), "sums")
    vocabulary = materialise(frequent.select("lang", "key", "word", "f").mapInArrow(_number(names), "id long, lang string, word string, f long"), "vocabulary")
    return words.groupBy("lang").agg(F.sum("f").alias("n")), vocabulary, sums


def mine(docs: DataFrame, least: int = LEAST, share: int = SHARE, most: int = MOST) -> DataFrame:
    """The first `most` phrases of each language: lang, rank, phrase, a, l, r, n, score, as op12's contract defines them.

    A null text is an empty one, a null lang `und`; languages without a candidate have no row. Whole texts are read, a long one by
    itself; repeated rows count each time; an empty table gives an empty result. Other columns are not read. Words are told apart by 64
    bits of word and language (among 10^9 different words a clash has a chance of 3 in 100). Scores are exact decimals.
    """
    totals, vocabulary, sums = count_phrases(docs, least)
    ids, size = F.col("ids"), F.size("ids")
    parts = sums.select("p", "q", F.col("a").alias("f")).unionByName(vocabulary.select(F.col("id").alias("p"), F.lit(WORD).cast("long").alias("q"), "f"))
    cuts = sums.select("p", "q", "a", "ids", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    (lp, lq), (rp, rq) = _part(ids, 1, F.col("k")), _part(ids, F.col("k") + 1, size - F.col("k"))
    cuts = cuts.select("p", "q", "a", "k", lp.alias("lp"), lq.alias("lq"), rp.alias("rp"), rq.alias("rq"))
    left, right = (parts.select(F.col("p").alias(f"{s}p"), F.col("q").alias(f"{s}q"), F.col("f").alias(s)) for s in "lr")
    cuts = cuts.join(left, ["lp", "lq"]).join(right, ["rp", "rq"])
    score = F.expr(f"(CAST(a AS DECIMAL(20, 0)) * CAST({FACTOR} AS DECIMAL(8, 0))) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    weakest = cuts.groupBy("p", "q").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    spans = [(n, first, length) for n in range(3, LONGEST + 1) for length in range(2, n) for first in range(1, n - length + 2)]
    inner = F.array(*(F.when(size == n, F.struct(*(c.alias(x) for c, x in zip(_part(ids, first, length), "pq", strict=True)))) for n, first, length in spans))
    longest = sums.where(size > 2).select("a", F.explode(F.array_compact(inner)).alias("s")).groupBy("s.p", "s.q").agg(F.max("a").alias("longer"))
    rows = sums.join(longest, ["p", "q"], "left")
    wide = lambda c, by: F.col(c).cast("decimal(20,0)") * F.lit(by).cast("decimal(4,0)")
    rows = rows.where(F.col("longer").isNull() | (wide("longer", 100) < wide("a", share))).join(weakest, ["p", "q"])
    spelled = rows.select("p", "q", F.posexplode("ids").alias("at", "id")).join(vocabulary.select("id", "word", "lang"), "id")
    spelled = spelled.groupBy("p", "q").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("ws"), F.first("lang").alias("lang"))
    rows = rows.join(spelled.select("p", "q", "lang", F.array_join("ws.word", " ").alias("phrase")), ["p", "q"])
    rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each of 64 parts of a language gives its first ones, so that no task sorts all of a language
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= most)
    rows = rows.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '{UNKNOWN_LANG}') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents
), p AS (
  SELECT doc, lang, unnest(range(1, len(ps) + 1)) AS piece, unnest(ps) AS t FROM d
), l AS (
  SELECT doc, lang, piece, list_filter(regexp_split_to_array(t, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), w AS (
  SELECT doc, lang, piece, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS a FROM l
), g AS (
  SELECT lang, a, lead(a, 1) OVER x AS b, lead(a, 2) OVER x AS c, lead(a, 3) OVER x AS d FROM w WINDOW x AS (PARTITION BY doc, piece ORDER BY i)
), f AS (
  SELECT lang, [a] AS ws, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, [a, b], count(*) FROM g WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}
  UNION ALL SELECT lang, [a, b, c], count(*) FROM g WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}
  UNION ALL SELECT lang, [a, b, c, d], count(*) FROM g WHERE d IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}
), cand AS (
  SELECT lang, ws, f AS a FROM f WHERE len(ws) > 1
), cuts AS (
  SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM cand
), scored AS (
  SELECT c.lang, c.ws, c.a, k, x.f AS l, y.f AS r, CAST(({FACTOR} * CAST(c.a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:k] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[k + 1:len(c.ws)]
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1
), spans(n, i, j) AS (
  VALUES (3, 1, 2), (3, 2, 3), (4, 1, 2), (4, 2, 3), (4, 3, 4), (4, 1, 3), (4, 2, 4)
), inner_of AS (
  SELECT lang, ws[i:j] AS ws, max(a) AS longer FROM cand JOIN spans ON n = len(ws) GROUP BY ALL
), kept AS (
  SELECT w.*, array_to_string(w.ws, ' ') AS phrase FROM weakest w LEFT JOIN inner_of i ON i.lang = w.lang AND i.ws = w.ws
  WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < {SHARE} * CAST(w.a AS HUGEINT)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN (SELECT lang, count(*) AS n FROM w GROUP BY lang) USING (lang) WHERE rank <= {MOST}
"""
