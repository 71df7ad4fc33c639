"""WARC records and the resolution of not-modified revisits, in DataFrame functions.

A revisit of the server-not-modified kind holds no body: it stands for the latest earlier full response of its canonical URL. An
as-of join finds that response, its validators are checked against the revisit's, and the header fields that a
304 answer may update are merged over the stored ones. The join runs in two levels, slices of time within a URL and
then whole slices; slices are cut at quantiles of all times, so one URL with a third of all records is spread over up to ``SLICES``
groups, whatever single times are wrong.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from genoframe.llm.workers import tidy

SLICES, STEP = 1024, 32
#: Fields of a 304 answer that replace the stored ones; query parameters that name no content.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)"
RESOLVED, NO_EARLIER, MISMATCH, NO_VALIDATOR = "resolved", "no_earlier_response", "validator_mismatch", "no_validator"

RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("at", T.LongType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("body", T.BinaryType()),
    ]
)


def canonical_url(url: Column) -> Column:
    """One name for the addresses of one resource: without scheme, user, ``www.`` or ``m.``, default port, fragment, tracking
    parameters, index page and final slash; the host in lower case, the other parameters sorted. Blank is null."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?@]*@)?", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^[^/?]*", 0)), r"^(?:www|m)\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/index\.html?$", "/"), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(rf"^{TRACKING}(?:=|$)")))
    whole = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(whole != "", whole)


def _field(headers: str, name: str) -> Column:
    return F.try_element_at(F.col(headers), F.lit(name))


def _strong(tag: Column) -> Column:
    """An entity tag without its mark of weakness: both sides are compared weakly."""
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def _slice(placed: DataFrame) -> Column:
    """The number of quantiles of all times below a row's time, found in two steps."""
    cuts = placed.agg(F.percentile_approx("at", [k / SLICES for k in range(1, SLICES)], 10_000)).first()[0] or []
    listed = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    below = lambda a: F.size(F.filter(a, lambda x: x < F.col("at")))
    coarse = below(F.array(*map(F.lit, cuts[STEP - 1 :: STEP]))) if cuts[STEP - 1 :: STEP] else F.lit(0)
    return coarse * STEP + below(F.slice(listed, coarse * STEP + 1, STEP - 1))


def _stored(r: DataFrame) -> DataFrame:
    """``target_id, stored`` of the responses; only if some id is repeated are rows gathered by id."""
    stored = r.where("full AND record_id IS NOT NULL").select(F.col("record_id").alias("target_id"), F.col("headers").alias("stored"))
    if stored.groupBy("target_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1").isEmpty():
        return stored
    return stored.groupBy("target_id").agg(F.max_by("stored", _as_text("stored")).alias("stored"))


def _as_text(headers: str) -> Column:
    """Headers in the order of their names, to compare those of responses that repeat an id."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))), "\n")


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records(record_id, kind, url, at, headers)``: ``record_id, canonical_url, at, status,
    target_id, headers``. ``record_id`` is unique, ``at`` a long in any unit, ``headers`` a map with lower-case names.

    ``target_id`` is the response of the same canonical URL with the greatest ``at`` below the revisit's, of equal times the
    greatest id. It is resolved if the revisit's entity tag equals the response's, or, without one, its last-modified;
    only then are ``headers`` the stored ones under the permitted ones of the revisit, else they are the revisit's
    own and ``target_id`` is null. Revisits with a null URL or time find no response; responses without an id are none, revisits
    without one are resolved like others; rows that repeat a revisit each give a row; of responses that repeat an id those with the
    greatest headers, as text, are stored; null headers are empty; kinds other than ``response`` and ``revisit`` are
    ignored; an empty table gives no rows; other columns are not read.
    """
    r = records.where("kind IN ('response', 'revisit')").select(
        "record_id", (F.col("kind") == "response").alias("full"), canonical_url(F.col("url")).alias("canonical_url"), "at", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers")
    )
    timed = F.col("canonical_url").isNotNull() & F.col("at").isNotNull()
    # revisits carry their headers, so they need not be found again by an id
    placed = r.where(timed & (~F.col("full") | F.col("record_id").isNotNull())).withColumn("headers", F.when(~F.col("full"), F.col("headers")))
    placed = placed.withColumn("slice", _slice(placed))
    response = F.when(F.col("full"), F.struct("at", "record_id"))
    slices = placed.groupBy("canonical_url", "slice").agg(F.max(response).alias("latest"))
    before = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("canonical_url", "slice", F.last("latest", ignorenulls=True).over(before).alias("carried"))
    earlier = Window.partitionBy("canonical_url", "slice").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    near = placed.withColumn("near", F.max(response).over(earlier)).where("NOT full")
    found = near.join(carried, ["canonical_url", "slice"], "left").select("record_id", "canonical_url", "at", "headers", F.coalesce("near", "carried")["record_id"].alias("target_id"))
    # without a target there is no key to join on, and all such rows would meet in one task
    without = found.where("target_id IS NULL").unionByName(r.where(~F.col("full") & ~timed).select("record_id", "canonical_url", "at", "headers", F.lit(None).cast(r.schema["record_id"].dataType).alias("target_id")))
    both = found.where("target_id IS NOT NULL").join(_stored(r), "target_id").unionByName(without, allowMissingColumns=True)
    tag, since = _field("headers", "etag"), _field("headers", "last-modified")
    same = F.when(tag.isNotNull(), F.coalesce(_strong(tag) == _strong(_field("stored", "etag")), F.lit(False))).otherwise(F.coalesce(since == _field("stored", "last-modified"), F.lit(False)))
    status = F.when(F.col("target_id").isNull(), NO_EARLIER).when(tag.isNull() & since.isNull(), NO_VALIDATOR).when(same, RESOLVED).otherwise(MISMATCH)
    update = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("stored", lambda k, _: ~F.array_contains(F.map_keys(update), k)), update)
    done = both.withColumn("status", status)
    ok = F.col("status") == RESOLVED
    return done.select("record_id", "canonical_url", "at", "status", F.when(ok, F.col("target_id")).alias("target_id"), F.when(ok, merged).otherwise(F.col("headers")).alias("headers"))


def with_bodies(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Adds ``body``, that of the target; null for revisits that are not resolved. Of responses that repeat an id it is that of the one whose
    headers are stored, of those with equal headers the greatest body; each row of ``resolved`` gives one row."""
    wanted = resolved.where("target_id IS NOT NULL")
    headers = F.coalesce("headers", F.create_map().cast("map<string,string>"))
    responses = records.where("kind = 'response' AND record_id IS NOT NULL").select(F.col("record_id").alias("target_id"), headers.alias("_h"), "body")
    # bodies that no revisit points to are not moved
    asked = responses.join(wanted.select("target_id").distinct(), "target_id", "left_semi")
    bodies = asked.groupBy("target_id").agg(F.max(F.struct(_as_text("_h"), "body"))["body"].alias("body"))
    without = resolved.where("target_id IS NULL").withColumn("body", F.lit(None).cast(records.schema["body"].dataType))
    return wanted.join(bodies, "target_id", "left").select(*resolved.columns, "body").unionByName(without)


def _fields(block: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = block.decode("utf-8", "replace").split("\r\n")
    out: dict[str, str] = {}
    name = None
    for line in lines:
        if line[:1] in (" ", "\t") and name:  # a folded line
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = f"{out[name]}, {value.strip()}" if name in out else value.strip()
    return first, out


def parse(data: bytes) -> Iterator[tuple]:
    """Rows of RECORDS of a WARC file, plain or compressed record by record; a cut-off record at the end is left out.

    HTTP headers are those of the block; ``at`` is in seconds. Revisits of other kinds than server-not-modified are ``other``.
    """
    from datetime import datetime, timezone

    if data[:2] == b"\x1f\x8b":
        try:
            data = gzip.decompress(data)
        except (EOFError, zlib.error):
            unpack, out = zlib.decompressobj(31), io.BytesIO()
            rest = data
            while rest:
                try:
                    out.write(unpack.decompress(rest))
                except zlib.error:
                    break
                rest, unpack = unpack.unused_data, zlib.decompressobj(31)
            data = out.getvalue()
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        _, fields = _fields(data[at:end])
        length = fields.get("content-length", "0")
        if not (length.isascii() and length.isdigit()):  # no record can be read here: the next one is looked for
            at = end + 4
            continue
        size = int(length)
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            return
        at = end + 4 + size
        kind = fields.get("warc-type", "")
        if kind == "revisit" and "server-not-modified" not in fields.get("warc-profile", "server-not-modified"):
            kind = "other"
        head, _, body = block.partition(b"\r\n\r\n")
        try:
            when = int(datetime.strptime(fields["warc-date"][:19], "%Y-%m-%dT%H:%M:%S").replace(tzinfo=timezone.utc).timestamp())
        except (KeyError, ValueError):
            when = None
        http = _fields(head)[1] if block.startswith(b"HTTP/") else {}
        yield fields.get("warc-record-id"), kind, fields.get("warc-target-uri", "").strip("<>") or None, when, http, body


def read(spark: SparkSession, path: str) -> DataFrame:
    """RECORDS of WARC files; each file is read by one task."""
    import pyarrow as pa

    from pyspark.sql.pandas.types import to_arrow_schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(RECORDS)
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for row in parse(data.as_py()):
                    rows.append(row)
                    if len(rows) == 500:
                        yield _batch(rows, schema)
                        rows = []
                if rows:
                    yield _batch(rows, schema)

    def _batch(rows, schema):
        columns = list(zip(*rows, strict=True))
        columns[4] = [list(x.items()) for x in columns[4]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(tidy(run), RECORDS)
