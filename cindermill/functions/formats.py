"""Scalar formats: names by date, storage locations, fingerprints, identities, paths. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The zone that names are dated in; how a path of the storage's own addresses begins; which UUIDs are valid where; release versions.
ZONE = "Asia/Shanghai"
STORAGE = "/storage/v1/s3/"
UUIDS = {name: f"(?i)^[0-9a-f]{{8}}-[0-9a-f]{{4}}-[{versions}][0-9a-f]{{3}}-[89ab][0-9a-f]{{3}}-[0-9a-f]{{12}}$" for name, versions in (("request", "1-8"), ("reference", "1-5"), ("job", "4"))}
RELEASE = "^[A-Za-z0-9](?:[A-Za-z0-9._-]{0,62}[A-Za-z0-9])?$"


def dated(at: Column, pattern: str) -> Column:
    """A UTC timestamp (without zone) as text of the names' zone."""
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(ZONE), at), pattern)


def result_set_name(at: Column) -> Column:
    return F.concat(F.lit("ResultSet-"), dated(at, "yyyyMMdd-HHmm"))


def release_name(at: Column) -> Column:
    return F.concat(dated(at, "yyyy.MM"), F.lit(".0"))


def storage_ref(url: Column) -> Column:
    """bucket, objectKey of a location (``s3://bucket/key``, or any address with the storage's path); null where it has not both."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    s3 = url.rlike(r"(?i)^s3://[^/?#]+")
    rest = F.when(F.instr(path, STORAGE) > 0, F.substring(path, F.instr(path, STORAGE) + len(STORAGE), F.length(path)))
    plain = lambda x: F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))  # noqa: E731  a plus is no blank in a path
    bucket = F.when(s3, F.lower(F.regexp_extract(url, r"(?i)^s3://(?:[^@/?#]*@)?([^/?#:]+)", 1))).otherwise(plain(F.substring_index(rest, "/", 1)))
    key = plain(F.when(s3, F.ltrim(path, F.lit("/"))).otherwise(F.when(F.instr(rest, "/") > 1, F.substring(rest, F.instr(rest, "/") + 1, F.length(rest)))))
    return F.when((F.length(bucket) > 0) & (F.length(key) > 0), F.struct(bucket.alias("bucket"), key.alias("objectKey")))


def project_url(url: Column) -> Column:
    """An address less trailing slashes and the path of its functions."""
    return F.regexp_replace(F.regexp_replace(F.trim(url), "/+$", ""), r"/functions/v1(?:/.*)?$", "")


def credentials(key: Column) -> Column:
    """email, password of an encoded key; null where one is missing or blank, or the key is none."""
    text = F.try_to_binary(F.trim(key), F.lit("base64")).cast("string")
    v = F.from_json(text, "email string, password string")
    email, password = F.trim(v["email"]), F.trim(v["password"])
    return F.when((F.length(email) > 0) & (F.length(password) > 0), F.struct(email.alias("email"), password.alias("password")))


def fingerprint(command_url: Column, key: Column) -> Column:
    """The hash of a target: its address, a zero byte and its key."""
    return F.sha2(F.concat(F.encode(command_url, "UTF-8"), F.unhex(F.lit("00")), F.encode(key, "UTF-8")), 256)


def valid_uuid(c: Column, where: str) -> Column:
    return c.rlike(UUIDS[where])


def valid_release(c: Column) -> Column:
    return c.rlike(RELEASE) & ~c.contains("..")


def intake_path(root: Column, calculation: Column, content_hash: Column) -> Column:
    return F.concat_ws("/", F.rtrim(root, F.lit("/")), F.lit("result-materialization"), F.lit("intakes"), calculation, content_hash)


def valid_time(c: Column) -> Column:
    """A text that reads as a timestamp, as it is; else null."""
    return F.when(F.try_to_timestamp(c).isNotNull(), c)
