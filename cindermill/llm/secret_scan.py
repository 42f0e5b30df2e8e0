"""Secret scans: fixed detectors, then strings in sensitive contexts that a primed compressor cannot shorten.

The detectors are the base. A candidate is a string of eight printable ASCII characters or more, less decoration at its
edges, with a digit and a letter, that begins within 40 characters after a sensitive word (or follows a candidate of 40
characters or more with white space alone between them, as the lines of a key file do) and does not touch a base span.

Its novelty is what it adds, in bytes, to the zstandard frame of its surroundings: the 1024 characters before and after it
(without its own copies), under a dictionary of identifiers. That dictionary is the identifiers that most documents of
the corpus hold (five at least), counted by Spark over all texts: whole words of letters, underscores and at most three
digits behind, so that what counts as a candidate hardly gets into it; 64 KiB at most. Strings made of what code and prose are made of cost few bytes; a candidate that costs 8 bytes or
more and 0.65 bytes a character or more is reported. Added spans are of the kind assign: a sensitive word assigns them.

Only identifiers and counts are shuffled; texts are read twice and stay in their tasks, the dictionary is bounded. Work is
linear in a text's length. Null and empty texts have no spans; repeated rows give repeated rows; columns other than
``doc_id`` and ``text`` are not read; places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import kept, map_batches, staged

#: The detectors, in the order of kinds; letters of the first are of either case, ASCII only.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: What makes a context sensitive, and a text worth a look.
SENSITIVE = re.compile(r"pass(?:word|wd|phrase|code)|pwd|secret|token|credential|bearer|authorization|(?:api|access|private|auth|account|signing|encryption|master|shared|client)[\x20_-]?key", re.IGNORECASE | re.ASCII)
QUICK = ("pass", "pwd", "secret", "token", "credential", "bearer", "authorization", "key")
RUN = re.compile(r"[A-Za-z0-9+/_.~!@#$%^&*-]{8,}={0,2}")
LONG_HEX = re.compile(r"[0-9a-f]{32}")
EDGE_LEFT, EDGE_RIGHT = ".-*#!~", ".!*~"
SHORTEST, REACH, CHAIN = 8, 40, 40
#: Characters on either side that count as surroundings; the bytes, and bytes a character, that make a string novel.
AROUND, NOVEL_BYTES, NOVEL_SHARE = 1024, 8, 0.65
LEVEL, DICTIONARY_BYTES, DICTIONARY_WORDS = 19, 65_536, 16_384
IDENTIFIER = r"(?<![A-Za-z0-9_])([A-Za-z_]{3,40}[0-9]{0,3})(?![A-Za-z0-9_])"
#: Documents that an identifier of the dictionary is in, at least.
COMMON = 5


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the detectors' finds, in order."""
    low, out = text.lower(), []
    if any(w in low for w in ("pass", "secret", "token", "key")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if LONG_HEX.search(text):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Strings in sensitive contexts, in order, apart from base spans."""
    low = text.lower()
    if not any(w in low for w in QUICK):
        return []
    words = [m.end() for m in SENSITIVE.finditer(text)]
    out, word, held, last = [], -1, 0, -1
    for m in RUN.finditer(text) if words else ():
        while word + 1 < len(words) and words[word + 1] <= m.start():
            word += 1
        near = word >= 0 and m.start() - words[word] <= REACH
        chained = last >= 0 and not text[last : min(m.start(), last + REACH + 1)].strip() and m.start() - last <= REACH
        a = m.end() - len(m[0].lstrip(EDGE_LEFT))
        b = m.start() + len(m[0].rstrip(EDGE_RIGHT))
        while held < len(base) and base[held][2] <= a:
            held += 1
        free = not any(start < b for start, _, _ in base[held : held + 1])
        if (near or chained) and free and b - a >= SHORTEST and re.search("[0-9]", text[a:b]) and re.search("[A-Za-z]", text[a:b]):
            out.append((a, b))
            last = b if b - a >= CHAIN else -1
        else:
            last = -1
    return out


def identifiers(docs: DataFrame, words: int = DICTIONARY_WORDS) -> DataFrame:
    """word, n: the identifiers that most documents hold, at least ``COMMON``.

    A histogram of counts by powers of two tells how frequent those are that can be among them; only they are sorted, so
    that what each task sends does not add up with the number of tasks.
    """
    every = docs.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(IDENTIFIER)))).alias("word"))
    counts = staged(every.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON))
    level = F.floor(F.log2("n"))
    total, least = 0, 0
    for least, n in sorted(counts.groupBy(level).count().collect(), reverse=True):  # at most 64 rows
        total += n
        if total >= words:
            break
    return counts.where(level >= least).orderBy(F.desc("n"), "word").limit(words)


def dictionary(docs: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """The most frequent identifiers, at most ``size`` bytes; the nearest to the data (the end) are the most frequent."""
    out, n = [], 0
    for word, _ in identifiers(docs).collect():  # a bounded list
        n += len(word) + 1
        if n > size:
            break
        out.append(word)
    return " ".join(reversed(out)).encode()


@kept
def compressor(words: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if not words:
        return zstandard.ZstdCompressor(compression_params=how)
    primed = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=primed)


def marginal(text: str, a: int, b: int, words: bytes) -> int:
    """The bytes that text[a:b] adds to the frame of its surroundings."""
    string = text[a:b]
    around = f"{text[max(0, a - AROUND) : a]}\n{text[b : b + AROUND]}".replace(string, "").encode("utf-8", "surrogatepass") + b"\n"
    size = lambda x: len(compressor(words).compress(x))
    return size(around + string.encode()) - size(around)


def novel(text: str, base: list[tuple[int, int, int]], words: bytes) -> list[tuple[int, int, int]]:
    """(start, end, marginal bytes) of the candidates that do not compress."""
    found = ((a, b, marginal(text, a, b, words)) for a, b in candidates(text, base))
    return [(a, b, n) for a, b, n in found if n >= NOVEL_BYTES and n >= NOVEL_SHARE * (b - a)]


SPAN = "struct<start:long,kind:int,stop:long,bytes:int>"


def scanned(docs: DataFrame, words: bytes | None = None) -> DataFrame:
    """doc_id, base spans and all spans (arrays of start, kind, stop, marginal bytes of added ones; in order) of every row."""
    words = dictionary(docs) if words is None else words
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = lambda a, k, b, n=None: {"start": a, "kind": k, "stop": b, "bytes": n}

    def run(batch):
        base, every = [], []
        for text in batch.column(1).to_pylist():
            found = base_spans(text or "")
            more = novel(text or "", found, words)
            base.append([span(*x) for x in found])
            every.append([span(*x) for x in sorted([*found, *((a, 0, b, n) for a, b, n in more)])])
        return {"doc_id": batch.column(0), "base": base, "spans": every}

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, base array<{SPAN}>, spans array<{SPAN}>")


def listed(spans: str):
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["stop"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The base counts and digest, all spans, and how many of these the method added."""
    of = lambda k: F.filter("base", lambda x: x["kind"] == k)
    count = [F.size(of(k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return scanned(docs).select("doc_id", *count, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"), added)


def base_digest(text: str | None) -> str:
    """base_sha256 of one text, for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base_spans(text or "")).encode()).hexdigest()
