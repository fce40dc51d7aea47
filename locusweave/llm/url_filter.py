"""URL filter: a sorted array of 64-bit digests of rules, sites and words, mapped into memory and probed by binary search."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import opened, ship
from .common import table

#: Seed of Spark's xxhash64.
SEED = 42
ALLOW, BLOCK = "allow", "block"
#: What an entry of the list is. A rule's text is host and path; so is a blocked site's; a word is marked by the sign before it.
ALLOW_RULE, BLOCK_RULE, SITE, BLOCKED_WORD = range(4)
WORD_MARK = "*"
#: Bytes of all entries together that one list may have, which every executor keeps on its disk.
MOST_BYTES = 1 << 31

#: Rules of the query: (verdict, host and path).
RULES = ((ALLOW, "com/"), (BLOCK, "example.com/en/"), (ALLOW, "www.example.com/en/"), (BLOCK, "net/es/"), (BLOCK, "net/fr/"))
#: Words between the dots and hyphens of a host that block a page no rule speaks of.
WORDS = (
    "ads", "adult", "adserver", "bet", "bets", "betting", "casino", "casinos", "escort", "escorts", "gambling", "hentai", "pharma", "pills",
    "poker", "porn", "porno", "sex", "slots", "spam", "torrent", "torrents", "viagra", "warez", "xxx",
)


@dataclass(frozen=True)
class Digests:
    """A stored list: the names of its arrays, and which (labels of the host, characters of the path) its entries have."""

    names: dict[str, str]
    shapes: tuple[tuple[int, int], ...]
    mask: int


def _digest(text: bytes, mask: int) -> int:
    return xxhash.xxh64_intdigest(text, seed=SEED) & mask


def build(spark: SparkSession, rules: Iterable[tuple[str, str]] = RULES, sites: Iterable[str] = (), words: Iterable[str] = WORDS, bits: int = 64) -> Digests:
    """The list as arrays: digests in order, and for each its kind and its whole text. Fewer `bits` make digests clash (for tests).

    A rule or site is a host, lower case, and a path that begins with a slash. The list is a parameter, not corpus data: it is
    put together on the driver and may have MOST_BYTES bytes at most. Rules that say both of one place are an error.
    """
    kinds = {}
    for kind, texts in ((SITE, sites), (BLOCKED_WORD, (WORD_MARK + w for w in words))):
        kinds |= {t: kind for t in texts}
    said: dict[str, int] = {}
    for verdict, text in rules:
        kind = {ALLOW: ALLOW_RULE, BLOCK: BLOCK_RULE}[verdict]
        if said.setdefault(text, kind) != kind:
            raise ValueError(f"the rules both allow and block {text!r}")
    shapes = set()
    for text in [*said, *(t for t, k in kinds.items() if k == SITE)]:
        host, slash, path = text.partition("/")
        if not host or not slash:
            raise ValueError(f"{text!r} is not a host and a path")
        shapes.add((host.count(".") + 1, len(path) + 1))
    # a place can be a site and have a rule: both are kept, and the rule decides
    entries = [(t.encode(), k) for t, k in [*kinds.items(), *said.items()]]
    if (size := sum(len(t) for t, _ in entries)) > MOST_BYTES:
        raise ValueError(f"the list has {size} bytes, over {MOST_BYTES}")
    mask = (1 << bits) - 1
    digests = np.array([_digest(t, mask) for t, _ in entries], np.uint64)
    order = np.argsort(digests, kind="stable")
    texts = [entries[i][0] for i in order]
    arrays = {
        "digest": digests[order],
        "kind": np.array([entries[i][1] for i in order], np.int8),
        "end": np.cumsum([0, *map(len, texts)]).astype(np.int64),
        "text": np.frombuffer(b"".join(texts), np.uint8),
    }
    return Digests(ship(spark, "url-list", arrays), tuple(sorted(shapes)), mask)


def host_of(url: Column) -> Column:
    """After the first :// up to a slash, a question mark, a hash sign or the end, A-Z lower-cased; empty for null and without ://."""
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _probes(shapes: Sequence[tuple[int, int]]) -> Column:
    """What of a url the list could hold: ends of the host with beginnings of the path, of the entries' own shapes, and the host's words."""
    dots = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit("")))
    places = [F.when((dots >= labels - 1) & (F.length("path") >= chars), F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, chars))) for labels, chars in shapes]
    words = F.transform(F.array_distinct(F.split("host", "[^a-z0-9]+")), lambda w: F.concat(F.lit(WORD_MARK), w))
    return F.concat(F.array_compact(F.array(*places)), words) if places else words


def _judge(stored: Digests):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = opened(stored.names)
        digest, kind, end, text = (got[k] for k in ("digest", "kind", "end", "text"))
        for batch in batches:
            lists, keys = batch.column("__probes"), batch.column("__keys").flatten().to_numpy(zero_copy_only=False)
            keys = keys.view(np.uint64) & np.uint64(stored.mask)
            bounds = lists.offsets.to_numpy()
            keys, probes = keys[: bounds[-1] - bounds[0]], lists.flatten()
            at = np.searchsorted(digest, keys, "left")
            # of the probes those whose digest the array holds; entries with the same digest follow each other
            hit = np.flatnonzero(at < len(digest))
            hit = hit[digest[at[hit]] == keys[hit]]
            row = np.searchsorted(bounds - bounds[0], hit, "right") - 1
            n = batch.num_rows
            rule, rule_size, blocked, listed = [None] * n, np.full(n, -1), np.zeros(n, bool), [None] * n
            for i, p in zip(row.tolist(), hit.tolist(), strict=True):
                said, j = probes[p].as_py(), int(at[p])
                whole = said.encode()
                while j < len(digest) and digest[j] == keys[p]:
                    if text[end[j] : end[j + 1]].tobytes() == whole:
                        if kind[j] <= BLOCK_RULE:
                            # of two rules of one length that with the longer host decides
                            size = 4096 * len(said) + said.index("/")
                            if size > rule_size[i]:
                                rule[i], rule_size[i], blocked[i] = said, size, kind[j] == BLOCK_RULE
                        elif listed[i] is None or said < listed[i]:
                            listed[i] = said
                    j += 1
            verdict = [BLOCK if (blocked[i] if rule[i] is not None else listed[i] is not None) else ALLOW for i in range(n)]
            columns = {f.name: batch.column(f.name) for f in batch.schema if not f.name.startswith("__")}
            columns |= {"rule": pa.array(rule, pa.string()), "listed": pa.array(listed, pa.string()), "verdict": pa.array(verdict, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def judge(urls: DataFrame, stored: Digests, url: str = "url", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Per row the columns `keep`, host, path, the longest rule that fits (else null), the listed site or word found (else null) and the verdict.

    A rule fits its host and all subdomains where the path begins with the rule's; of rules of equal length that with the longer
    host decides. Without a rule, a listed site that fits or a blocked word of the host blocks, and all else is allowed. What a
    url could match is spelled out and hashed by Spark; tasks map the digests into memory, find all of a batch by one binary
    search, and compare the whole stored text of each hit, so that a clash of digests decides nothing.

    A null url, or one without ://, has an empty host and path, which nothing fits. Long urls are taken whole. Repeated rows are
    judged each on its own; an empty table gives an empty result. Other columns are not read; `keep` may not name a result.
    """
    rows = urls.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("__probes", _probes(stored.shapes)).withColumn("__keys", F.transform("__probes", lambda p: F.xxhash64(p)))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if not f.name.startswith("__")]
    return rows.mapInArrow(_judge(stored), ", ".join([*schema, "rule string", "listed string", "verdict string"]))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), build(spark)).select("page_id", "host", "path", "rule", "verdict", "listed")


_RULES_SQL = ", ".join(f"('{v}', '{t.partition('/')[0]}', '/{t.partition('/')[2]}')" for v, t in RULES)
SQL = rf"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(said, rule_host, rule_path) AS (
  VALUES {_RULES_SQL}
), best AS (
  SELECT r, said, rule_host || rule_path AS rule FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1
), w AS (
  SELECT r, min('{WORD_MARK}' || word) AS listed FROM (SELECT r, unnest(regexp_split_to_array(host, '[^a-z0-9]+')) AS word FROM p)
  WHERE word IN ({", ".join(f"'{w}'" for w in WORDS)}) GROUP BY r
)
SELECT page_id, host, path, rule, CASE WHEN said IS NOT NULL THEN said WHEN listed IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict, listed
FROM p LEFT JOIN best USING (r) LEFT JOIN w USING (r)
"""
