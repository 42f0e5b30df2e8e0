"""Canonical JSON (RFC 8785), ES6 numbers, NFC, UUIDv5: what Spark has no function for. Arrow-batched UDFs."""

from __future__ import annotations

import hashlib
import json
import math
import re
import unicodedata
import uuid

import pandas as pd
from pyspark.sql import functions as F


def es6_number(x: float) -> str:
    """The shortest text of a double as ECMAScript prints it."""
    if not math.isfinite(x):
        raise ValueError("not a finite number")
    if x == 0:
        return "0"
    sign, s = ("-", repr(-x)) if x < 0 else ("", repr(float(x)))
    digits, _, exponent = s.partition("e")
    whole, _, part = digits.partition(".")
    point = len(whole) + int(exponent or 0)
    all_digits = (whole + part).lstrip("0")
    point -= len(whole + part) - len(all_digits)
    d = all_digits.rstrip("0")
    n, k = point, len(d)
    if k <= n <= 21:
        return sign + d + "0" * (n - k)
    if 0 < n <= 21:
        return sign + d[:n] + "." + d[n:]
    if -6 < n <= 0:
        return sign + "0." + "0" * -n + d
    e = f"e{'+' if n > 0 else '-'}{abs(n - 1)}"
    return sign + d[0] + ("." + d[1:] if k > 1 else "") + e


#: The JSON text of a string; json.dumps would make an encoder a call.
_quoted = json.JSONEncoder(ensure_ascii=False).encode


def canonical_json(value, nfc: bool = False) -> str:
    """RFC 8785 text; keys in UTF-16 order; with ``nfc`` all strings are normalised first."""
    fold = (lambda s: unicodedata.normalize("NFC", s)) if nfc else (lambda s: s)
    if value is None or isinstance(value, bool):
        return json.dumps(value)
    if isinstance(value, str):
        return _quoted(fold(value))
    if isinstance(value, (int, float)):
        return es6_number(float(value))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canonical_json(v, nfc) for v in value) + "]"
    items = sorted(((fold(k), v) for k, v in value.items()), key=lambda kv: kv[0].encode("utf-16-be"))
    return "{" + ",".join(f"{_quoted(k)}:{canonical_json(v, nfc)}" for k, v in items) + "}"


def without_keys(value, keys: frozenset[str]):
    """``value`` less the named keys, at any depth."""
    if isinstance(value, dict):
        return {k: without_keys(v, keys) for k, v in value.items() if k not in keys}
    return [without_keys(v, keys) for v in value] if isinstance(value, list) else value


def _of(f):
    return F.pandas_udf(lambda s: s.map(lambda x: None if x is None else f(x)), "string")


def json_hash(column, nfc: bool = True, without: tuple[str, ...] = ()):
    """sha256 of the canonical text of a JSON column, less some keys."""
    drop = frozenset(without)
    return _of(lambda x: hashlib.sha256(canonical_json(without_keys(json.loads(x), drop), nfc).encode()).hexdigest())(column)


def canonical_text(column, nfc: bool = True):
    """The canonical text of a JSON column."""
    return _of(lambda x: canonical_json(json.loads(x), nfc))(column)


def nfc(column):
    return _of(lambda x: unicodedata.normalize("NFC", x))(column)


def number_text(column):
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None or x != x else es6_number(x))

    return F.pandas_udf(run, "string")(column)


def name_uuid(column, namespace: str):
    """UUIDv5 of a text column in a namespace."""
    space = uuid.UUID(namespace)
    return _of(lambda x: str(uuid.uuid5(space, x)))(column)


#: What does not count as a change of a document; the namespaces and the profile of the identities.
NOT_SIGNIFICANT = (
    "common:dataSetVersion", "common:dateOfLastRevision", "common:permanentDataSetURI", "common:referenceToPrecedingDataSetVersion", "common:timeStamp",
)
MODEL_NAMESPACE = "1f09df9a-9a14-5247-a355-90ce73b521dd"
RESULT_NAMESPACE = "6d130f3d-ca65-5a6f-a842-4b2f9c2f5461"
MODEL_PROFILE = "resolved-one-hop-aggregated-background.v1"


def result_uuid(process: str, flow: str):
    """The identity of a process's result: UUIDv5 of the canonical document of both ids in lower case."""
    return name_uuid(F.to_json(F.struct(F.lower(flow).alias("referenceFlowUuid"), F.lower(process).alias("rootProcessUuid"))), RESULT_NAMESPACE)


def model_uuid(process: str, flow: str, schema: str):
    """The identity of a process's model; ``schema`` names the contract of the identity document."""
    fields = F.lit(MODEL_PROFILE).alias("modelProfileId"), F.lower(flow).alias("referenceFlowUuid"), F.lower(process).alias("rootProcessUuid"), F.lit(schema).alias("schema")
    return name_uuid(F.to_json(F.struct(*fields)), MODEL_NAMESPACE)


def bundle_hash(raw: bytes) -> str:
    """sha256 of a manifest's bytes less its one canonical field of the hash itself; the bytes are not parsed."""
    field = rb'"bundleContentHash":"[0-9a-f]{64}",'
    if len(re.findall(field, raw)) != 1:
        raise ValueError("bundle_content_hash_field_invalid")
    return hashlib.sha256(re.sub(field, b"", raw)).hexdigest()
