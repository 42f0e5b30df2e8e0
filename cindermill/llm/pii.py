"""Personal data: fixed detectors, then bootstrapped contextual extraction.

The detectors' finds (seeds) and every other identifier-like string (three digits or more, or an at sign) are
mentions. Such a string is a run without white space, less the punctuation at its edges, or one to four groups of
digits in a row, joined by the separators of cards and phones (or the whole row of groups); one may lie in the
other, and both are added if both are accepted. Beside the four kinds of personal data there is a fifth, secret,
whose labels are the candidates of 16 letters and digits or more in five runs or more that change between the two.
These labels are for the graph alone: a secret is reported, apart from the spans of the four kinds, if patterns
accept it.

A mention gives eight lexical patterns: the word before it, its shape, the word after it (all three, without the
right word, without the left word, without the shape), its shape alone and with the lengths of runs of digits, its
first four characters with its length, and where only punctuation precedes it, the word before that (``token = "``)
with its shape. In a shape a run of digits is 9, of letters a, of both in turn x. Long strings and words go by
their hash. Spark scores the bipartite graph of patterns and instances for a few rounds: a pattern's confidence
for a kind is the smoothed share of its distinct instances known to be of that kind, the instance in question left
out; an instance is accepted when patterns of high confidence agree on it (noisy-or), and accepted instances
support patterns in the next round. All occurrences of accepted instances are added as spans of that kind.

Only mentions are shuffled, never texts. Null and empty texts have no spans; repeated rows give repeated rows;
columns other than ``doc_id`` and ``text`` are not read; places are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cindermill.llm.common import discard, map_batches, staged

#: The detectors, in the order of kinds. An email's local part, which ends at an at sign, is found
#: backwards from there; an IP starts where a run of digits does. So both are linear on texts without spaces.
KINDS = ("email", "ip", "card", "phone")
#: The kinds of the graph: those, and one that the method alone gives.
ALL_KINDS, SECRET = (*KINDS, "secret"), 4
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
RUN = re.compile(r"[^\s\"'<>,;=]+")
DIGITS = re.compile(r"[0-9]")
GROUPS = re.compile(r"[+(]?[0-9](?:[\x20().-]*[0-9])*")
TOKEN = re.compile(r"[A-Za-z0-9]{16,}")
#: Groups of digits in one candidate, apart from a whole row of them.
MOST_GROUPS = 4
EDGE = "!?.:*_~`|/\\()[]{}-#&"
QUICK = re.compile(r"[0-9]|@")
#: Longer strings, shapes and words are hashed.
LONG_INSTANCE, LONG_SHAPE = 200, 40
AROUND = 24
#: The word that names a mention: letters, then a few signs up to the mention; looked for in so many characters.
NAMED = re.compile(r"([^\W\d_]+)[^\w\n]{1,6}\Z")
NAME_WINDOW = 48
ROUNDS, CONFIDENT, ACCEPT, SUPPORT = 3, 0.8, 0.9, 5


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: for every at sign, the run of local characters before it and the domain after it."""
    out, edge, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > edge and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, edge := m.end()))
        at = text.find("@", at + 1)
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs and groups of digits that hold three digits or more, or (runs) an at sign inside; in order, no repeats."""
    if not QUICK.search(text):
        return []
    out = set()
    for m in GROUPS.finditer(text):
        if " " in m[0]:
            parts = [(m.start() + a, m.start() + b) for a, b in (x.span() for x in re.finditer(r"[^ ]+", m[0]))]
            some = {(a, b) for i, (a, _) in enumerate(parts) for _, b in parts[i : i + MOST_GROUPS]}
            out |= {(a, b) for a, b in {m.span(), *some} if len(DIGITS.findall(text, a, b)) >= 3}
    for m in RUN.finditer(text):
        a, b = m.start() + len(m[0]) - len(m[0].lstrip(EDGE)), m.end() - len(m[0]) + len(m[0].rstrip(EDGE))
        if a < b and (len(DIGITS.findall(m[0])) >= 3 or "@" in text[a + 1 : b - 1]):
            if text[a - 1 : a] == "(" and ")" in text[a:b]:  # the bracket belongs to what follows
                a -= 1
            out.add((a, b))
    return sorted(out)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the detectors' finds, in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    if QUICK.search(text):
        for m in IP.finditer(text) if "." in text else ():
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text) if "+" in text else ():
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def short(s: str, limit: int) -> str:
    return s if len(s) <= limit else "#" + hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def secret(s: str) -> bool:
    """A label of the fifth kind: letters and digits in turn, as keys and tokens have them."""
    return bool(TOKEN.fullmatch(s)) and len(re.findall(r"[0-9]+|[A-Za-z]+", s)) >= 5


def shape(s: str, lengths: bool = False) -> str:
    """Runs of digits as 9, of letters as a, of both in turn as x; other characters stay. ``lengths``: of runs with digits."""

    def run(m: re.Match) -> str:
        x = m[0]
        kind = "9" if x.isdigit() else "a" if not DIGITS.search(x) else "x"
        return f"{kind}{len(x)}" if lengths and kind != "a" else kind

    return short(re.sub(r"(?:[0-9]|[^\W\d_])+", run, s), LONG_SHAPE)


def contexts(text: str, spans: list[tuple[int, int]]) -> tuple[dict[int, str], dict[int, str]]:
    """By start the word (or its part) before, by end the word after; long ones by a hash that goes on from one to the next."""
    words = [m.span() for m in re.finditer(r"\S+", text)] if spans else []
    starts, ends, left, right = [a for a, _ in words], [b for _, b in words], {}, {}
    at, digest = (-1, 0), None
    for p in sorted({a for a, _ in spans}):
        i = bisect.bisect_left(starts, p) - 1
        if i < 0:
            left[p] = "^"
            continue
        a, b = words[i][0], min(words[i][1], p)
        if b - a <= AROUND:
            left[p] = text[a:b].lower()
            continue
        if at[0] != a:
            at, digest = (a, a), hashlib.sha256()
        digest.update(text[at[1] : b].lower().encode("utf-8", "surrogatepass"))
        at, left[p] = (a, b), "#" + digest.hexdigest()
    at, digest = (-1, 0), None
    for p in sorted({b for _, b in spans}, reverse=True):
        i = bisect.bisect_right(ends, p)
        if i == len(words):
            right[p] = "$"
            continue
        a, b = max(words[i][0], p), words[i][1]
        if b - a <= AROUND:
            right[p] = text[a:b].lower()
            continue
        if at[0] != b:
            at, digest = (b, b), hashlib.sha256()
        digest.update(text[a : at[1]].lower()[::-1].encode("utf-8", "surrogatepass"))
        at, right[p] = (b, a), "#" + digest.hexdigest()
    return left, right


def named(text: str, start: int) -> str | None:
    """The word that names a mention after punctuation; None where a word or white space alone precedes it."""
    before = text[max(0, start - NAME_WINDOW) : start]
    return m[1].lower() if (m := NAMED.search(before)) and before[-1:].strip() else None


#: A mention: its place, kind or None, instance, left word, right word, shape, shape with lengths, the word that names it.
FIELDS = {"start": "long", "stop": "long", "kind": "int", "instance": "string", "l": "string", "r": "string", "shape": "string", "exact": "string", "name": "string"}


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int | None, str, str, str, str, str, str | None]]:
    """The mentions of a text (``FIELDS``): base spans and the candidates apart from them."""
    out, edge, held = [(a, b, k) for a, k, b in base], 0, [(a, b) for a, _, b in base]
    for a, b in candidates(text):
        while edge < len(held) and held[edge][1] <= a:
            edge += 1
        if not (edge < len(held) and held[edge][0] < b):
            out.append((a, b, SECRET if secret(text[a:b]) else None))
    left, right = contexts(text, [(a, b) for a, b, _ in out])
    return [(a, b, k, short(text[a:b].lower(), LONG_INSTANCE), left[a], right[b], shape(text[a:b]), shape(text[a:b], lengths=True), named(text, a)) for a, b, k in out]


def patterns() -> list:
    """The patterns of a mention's columns, null where it has none of a variant; the first letter tells the variants apart."""
    parts = {"b": ("l", "shape", "r"), "l": ("l", "shape"), "r": ("shape", "r"), "w": ("l", "r"), "s": ("exact",), "g": ("shape",)}
    affix = (F.substring("instance", 1, 4), F.length("instance").cast("string"))
    named = F.when(F.col("name").isNotNull(), F.concat_ws("\t", F.lit("n"), "name", "shape"))
    return [*(F.concat_ws("\t", F.lit(k), *of) for k, of in (parts | {"p": affix}).items()), named]


def found(docs: DataFrame) -> DataFrame:
    """Of every row: a row key (task and number), doc_id, the base spans and all mentions."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    seen: dict[int, int] = {}

    def run(batch):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        base = [base_spans(t) for t in texts]
        task = TaskContext.get().partitionId()
        at = seen.setdefault(task, 0)
        seen[task] += len(texts)
        return {
            "doc_id": batch.column(0), "row": [(task << 33) + at + i for i in range(len(texts))], "base": [[{"start": a, "kind": k, "stop": b} for a, k, b in x] for x in base],
            "mentions": [[dict(zip(FIELDS, m, strict=True)) for m in mentions(t, b)] for t, b in zip(texts, base, strict=True)],
        }

    fields = ",".join(f"{name}:{of}" for name, of in FIELDS.items())
    spec = f"doc_id {kind}, row long, base array<struct<start:long,kind:int,stop:long>>, mentions array<struct<{fields}>>"
    return map_batches(docs.select("doc_id", "text"), run, spec)


def edges_of(m: DataFrame) -> DataFrame:
    """pattern, instance, kind (null: unknown) of mentions, no repeats."""
    return m.select(F.explode(F.array_compact(F.array(*patterns()))).alias("pattern"), "instance", "kind").distinct()


def accepted(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """instance, kind of what the patterns accept, seeds of the base kinds apart. ``edges``: as ``edges_of`` gives them.

    An instance of a known kind never supports itself: it is left out of the counts of its own patterns.
    """
    seeds = staged(edges.where("kind is not null").groupBy("instance").agg(F.min("kind").alias("known")))
    graph = staged(edges.select("pattern", "instance").distinct())
    known, made = seeds, [seeds, graph]
    for _ in range(rounds):
        labelled = graph.join(known, "instance", "left")
        per = labelled.groupBy("pattern", "known").agg(F.count("*").alias("n"))
        total = per.groupBy("pattern").agg(F.sum("n").alias("total"))
        share = per.where("known is not null").join(total, "pattern")
        sure = share.where((F.col("n") / (F.col("total") + 1) >= CONFIDENT) & (F.col("n") >= SUPPORT)).select("pattern", F.col("known").alias("kind"), "n", "total")
        sure = staged(sure)  # one row a pattern and kind: apart from its aggregation, the join below can split frequent patterns
        own = F.coalesce(F.col("known") == F.col("kind"), F.lit(False)).cast("int")
        votes = labelled.join(sure, "pattern").select("instance", "kind", (F.col("n") - own).alias("n"), ((F.col("n") - own) / (F.col("total") + 1 - own)).alias("confidence"))
        votes = votes.where((F.col("confidence") >= CONFIDENT) & (F.col("n") >= SUPPORT))
        score = votes.groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
        best = score.groupBy("instance").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
        fresh = staged(best.where(F.col("best.score") >= ACCEPT).select("instance", (-F.col("best.k")).alias("known")))
        known = seeds.union(fresh.join(seeds, "instance", "left_anti"))
        made += [sure, fresh]
    out = staged(fresh.join(seeds.where(F.col("known") != SECRET), "instance", "left_anti").withColumnRenamed("known", "kind"))
    discard(*made)
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base spans, all spans of the four kinds and the secrets (arrays of start, kind, stop in order) of every row."""
    rows = staged(found(docs))
    m = rows.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    fresh = accepted(edges_of(m)).withColumnRenamed("kind", "fresh")
    more = m.where((F.col("kind").isNull()) | (F.col("kind") == SECRET)).join(fresh, "instance").select("row", "start", F.col("fresh").alias("kind"), "stop")
    added = more.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("added"))
    none = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint>>")
    every = F.array_sort(F.concat("base", F.coalesce(F.filter("added", lambda x: x["kind"] != SECRET), none)))
    secrets = F.array_sort(F.coalesce(F.filter("added", lambda x: x["kind"] == SECRET), none))
    return rows.select("row", "doc_id", "base").join(added, "row", "left").select("doc_id", "base", every.alias("spans"), secrets.alias("secrets"))


def listed(spans: str):
    kinds = F.array(*map(F.lit, ALL_KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["stop"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The base counts and digest, all spans, the secrets' places, how many spans the method added and how many secrets."""
    kinds = F.transform("base", lambda x: x["kind"])
    count = [F.size(F.array_remove(kinds, k)) for k in range(len(KINDS))]
    count = [(F.size("base") - c).cast("long").alias(f"n_{kind}") for c, kind in zip(count, KINDS, strict=True)]
    more = [c.cast("long").alias(name) for c, name in ((F.size("spans") - F.size("base"), "n_added"), (F.size("secrets"), "n_secret"))]
    return personal_data(docs).select("doc_id", *count, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"), listed("secrets").alias("secrets"), *more)


def base_digest(text: str | None) -> str:
    """base_sha256 of one text, for tests."""
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base_spans(text or "")).encode()).hexdigest()
