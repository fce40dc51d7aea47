"""Operator 1: secret scans. Fixed patterns, and strings that a primed compressor finds new in a sensitive context."""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: Shorter matches of [A-Z0-9]+ and [0-9a-f]+ fail, and no longer one starts inside a failing one.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A text without any of these, in lower case, has no match of ASSIGN.
NEEDLES = ("password", "passwd", "secret", "token", "api_key", "apikey")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Short words count only by themselves (not in monkey or rapid); a capital may follow, as in apiKey.
_WORDS = (
    r"(?:(?ai:pass(?:word|wd|phrase)|secret|token|bearer|credential|private|signature|authori[sz]ation)"
    r"|(?<![A-Za-z])(?ai:keys?|api|salt|auth|pass)(?![a-z]))"
)
#: A sensitive word on the same line, or on the line above a candidate that begins its own.
SENSITIVE = re.compile(_WORDS + r"[^\n]{0,24}$")
ABOVE = re.compile(_WORDS + r"[^\n]{0,48}\n[\x20\t\"'>#*|+-]{0,24}$")
#: What stands between the segments of a dotted key, or the lines of a wrapped one.
GOES_ON = re.compile(r"(?:\.[A-Za-z0-9+/_=-]{0,15}){0,8}\.|[\"'\\]{0,2}\r?\n[\x20\t\"'>#*|+-]{0,24}")
#: What identifiers and settings around a secret commonly consist of; it primes the compressor.
IDENTIFIERS = (
    "access account address admin alpha api app application arg array async auth authorization base64 bearer begin bool bucket build "
    "byte cache callback certificate char class client cloud code com common config connection const content context cookie count "
    "credential data database date debug default delete dev digest dir domain driver email encoding encrypt endpoint env environment "
    "error example export false file filter format function github hash header host http https id image import index init input "
    "instance int interface internal item json key label length list local localhost log login main manager map master message method "
    "mode model module name namespace net network node null number object offset option org output package page param parameter "
    "parent parse passphrase passwd password path payload pem port post prefix private prod production profile project properties "
    "protected proxy public query read region register release remote request resource response result return role root salt schema "
    "scope secret section self server service session setting sha256 signature size source ssh ssl staging start state static status "
    "stop storage string struct system table target task temp test text thread time timeout timestamp title tls token true type uid "
    "undefined update uri url user username utf8 uuid value var variable vault version view void web window worker write www xml yaml "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ _ID= _KEY= _TOKEN= _SECRET= "
)
CONTEXT = 256
LEVEL, DICTIONARY, SAMPLES = 12, 8192, 3000
#: Bytes a character that a random string adds at least while short; a long one adds what its alphabet must (see needed).
NOVELTY = 0.86
#: Parts of it for strings of hex digits, and for those of digits and letters of one case: fewer signs, cheaper codes.
HEX_PART, ONE_CASE_PART = 0.81, 0.91
#: What a string of 64 characters needs less of a character than one of 32.
LATER = 0.07
ENTROPY, PER_SYMBOL = 0.97, 0.45


@cache
def _primed():
    """A compressor whose dictionary is trained on identifiers, names, paths and dates made up of IDENTIFIERS, by a fixed rule:
    it knows the words, and how often letters, digits and signs occur in strings that are no secrets."""
    import zstandard as zstd

    rng, words, samples = random.Random(SAMPLES), [w for w in IDENTIFIERS.split() if w.islower() and len(w) < 20], []
    for i in range(SAMPLES):
        some = rng.choices(words, k=rng.randint(2, 8))
        sep = rng.choice(["-", "_", ".", " ", "/", "=", ": ", ", "])
        tail = ["", "", f"{sep}{rng.randint(1, 9999)}", f" 20{rng.randint(10, 39)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"][i % 4]
        samples.append(((some[0] + "".join(map(str.capitalize, some[1:])) if i % 4 == 1 else sep.join(some)) + tail).encode())
    known = zstd.train_dictionary(DICTIONARY, samples, k=256, d=8)
    known.precompute_compress(level=LEVEL)
    packer = zstd.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False)
    fixed = IDENTIFIERS[:700].encode()
    return packer, fixed, len(packer.compress(fixed))


def marginal_bytes(before: bytes, after: bytes, found: bytes) -> float:
    """Bytes that `found` adds to what its surroundings compress to, identifiers being known to the compressor: the mean of what it
    adds to the text before it, to the text after it and to plain identifiers, each long enough for the entropy stage to work;
    not less than the last, as a key's other lines are no measure for it."""
    packer, fixed, size = _primed()
    adds = [len(packer.compress(x + found)) - len(packer.compress(x)) for x in (before, after)]
    plain = len(packer.compress(fixed + found)) - size
    return max(plain, (sum(adds) + plain) / 3)


def alphabet(word: str) -> int:
    """Characters of the smallest usual alphabet that the string is drawn from: hex, base32, one case, both, with symbols."""
    seen = set(word.rstrip("="))
    lower, upper, digits = ({c for c in seen if f(c)} for f in (str.islower, str.isupper, str.isdigit))
    letters = sum(0 if not x else 6 if x <= set("abcdefABCDEF") else 26 for x in (lower, upper))
    few = digits <= set("234567") and letters == 26
    return letters + (0 if not digits else 6 if few else 10) + len(seen - lower - upper - digits)


def needed(word: str, novelty: float = NOVELTY) -> float:
    """Bytes that a random string as long and of the same alphabet adds at least: codes of the surroundings while short, then
    the alphabet's entropy a character and a table."""
    n, seen = alphabet(word), set(word.rstrip("="))
    mixed = 10 * min(sum(map(str.islower, word)), sum(map(str.isupper, word))) >= len(word)
    part = HEX_PART if n <= 16 else 1.0 if mixed or not all(map(str.isalnum, seen)) else ONE_CASE_PART
    share = part * (novelty - LATER * min(1.0, max(0.0, len(word) / 32 - 1)))
    return min(share * len(word), ENTROPY * len(word) * math.log2(max(2, n)) / 8 + PER_SYMBOL * n)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    low = text.lower()
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if any(x in low for x in NEEDLES) else []
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def novel_spans(text: str, base: list[tuple[int, int, str]], novelty: float = NOVELTY) -> tuple[list[tuple[int, int, str]], float]:
    """Strings in a sensitive context that hardly compress, outside the base spans; and the largest novelty of any candidate, base ones included."""
    out, most, last = [], 0.0, -1  # last: where the latest candidate in a sensitive context ends
    begins, ends = [], []  # of the stretches that base spans cover
    for s, e, _ in sorted(base):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            begins.append(s)
            ends.append(e)
    for m in CANDIDATE.finditer(text):
        word = m[0]
        k = bisect_left(begins, m.end())
        inside = k > 0 and m.start() < ends[k - 1]
        near = (
            last >= 0 and m.start() - last <= 160 and GOES_ON.fullmatch(text, last, m.start())
            or SENSITIVE.search(text, max(0, m.start() - 48), m.start())
            or ABOVE.search(text, max(0, m.start() - 96), m.start())
        )
        if near:
            last = m.end()
        if not inside and not near:
            continue
        before, after = text[max(0, m.start() - CONTEXT) : m.start()], text[m.end() : m.end() + CONTEXT]
        adds = marginal_bytes(before.encode("utf-8", "replace"), after.encode("utf-8", "replace"), word.encode())
        most = max(most, adds / len(word))
        if not inside and adds >= needed(word, novelty):
            out.append((m.start(), m.end(), "novel"))
    return out, most


def digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def scan(text: str | None, novelty: float = NOVELTY) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], float]:
    """Base spans, added spans, largest novelty. Positions are code points, ends exclusive. A null text has none."""
    if not text:
        return [], [], 0.0
    base = base_spans(text)
    return base, *novel_spans(text, base, novelty)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base, more, most = scan(text)
            count = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
            rows.append((*count, hashlib.sha256(digest(base).encode()).hexdigest(), digest(base + more), len(more), most))
        n_assign, n_access, n_hex, sha, spans, novel, most = zip(*rows, strict=True) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_assign, pa.int64()), pa.array(n_access, pa.int64()), pa.array(n_hex, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array(novel, pa.int64()), pa.array(most, pa.float64())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel", "max_novelty"],
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text, ...): how many base spans of each kind, their digest, and all spans.

    One pass without a shuffle. Null and empty texts give zero counts and an empty list, an empty table gives an empty result;
    repeated rows are scanned alike; texts of any length are scanned whole; other columns are not read, whatever their names.
    """
    return docs.select("doc_id", "text").mapInArrow(
        _scan_batches, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long, max_novelty double"
    )


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span found, overlapping ones together, replaced by a mark."""
    if not text:
        return text
    base, more, _ = scan(text)
    out, at = [], 0
    for s, e, _ in sorted(base + more):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
