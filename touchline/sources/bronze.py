"""Bronze snapshots: raw JSON text, one folder per endpoint and run.

Layout: ``<root>/<endpoint>/run_timestamp=<run>/``, one document per line so that large landings
split. ``read_files`` reads landings with one document per file instead; the loaders take either.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from touchline.functions.json_text import STRICT, with_fields

# Endpoints, and the array of the bootstrap document behind each silver table.
BOOTSTRAP, FIXTURES, SUMMARIES, RUNS = "bootstrap-static", "fixtures", "element-summaries", "runs"
BOOTSTRAP_ARRAYS = {
    "players": "elements",
    "teams": "teams",
    "matches": "events",
    "player_types": "element_types",
}
RUN_FORMAT = "%Y-%m-%dT%H:%M:%SZ"


def run_path(root: str, endpoint: str, run: str) -> str:
    return f"{root}/{endpoint}/run_timestamp={quote(run, safe='')}"


def new_run() -> str:
    """Name of a run that starts now."""
    return format(datetime.now(timezone.utc), RUN_FORMAT)


def write_documents(documents: DataFrame, root: str, endpoint: str, run: str) -> None:
    """Land one snapshot. ``documents`` has a single string column of JSON documents.

    Line breaks in JSON text are white space between tokens, so blanks can stand for them.
    """
    (value,) = documents.columns
    one_line = documents.select(F.translate(value, "\r\n", "  ").alias("value"))
    one_line.write.mode("overwrite").text(run_path(root, endpoint, run))


def announce_run(spark: SparkSession, root: str, run: str) -> None:
    """Mark a run as completely landed; loaders follow these marks."""
    mark = spark.range(1).select(F.lit(run).alias("run_timestamp"))
    mark.write.mode("append").json(f"{root}/{RUNS}")


def read_documents(spark: SparkSession, root: str, endpoint: str, run: str) -> DataFrame:
    return spark.read.text(run_path(root, endpoint, run))


def read_files(spark: SparkSession, root: str, endpoint: str, run: str) -> DataFrame:
    """The same from a landing with one document per file: ``<root>/<endpoint>/<run>.json``, and a
    folder ``<root>/element-summaries/<run>/`` with a file per player."""
    path = f"{root}/{endpoint}/{run}" + ("/" if endpoint == SUMMARIES else ".json")
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path"))


def landed_runs(spark: SparkSession, root: str) -> DataFrame:
    """``run_timestamp`` of every run with files of all endpoints, in either layout.

    Only the names of files are read. All endpoints must have a folder.
    """
    endpoints = (BOOTSTRAP, FIXTURES, SUMMARIES)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    paths = files.load([f"{root}/{e}" for e in endpoints]).select("path")
    pattern = rf".*/({'|'.join(endpoints)})/([^/]+)"
    endpoint, own = (F.regexp_extract("path", pattern, i) for i in (1, 2))
    quoted = F.replace(F.regexp_replace(own, "^run_timestamp=", ""), F.lit("+"), F.lit("%2B"))
    named = F.when(own.startswith("run_timestamp="), F.try_url_decode(quoted))
    run = named.otherwise(F.regexp_replace(own, r"\.json$", ""))
    found = paths.select(run.alias("run_timestamp"), endpoint.alias("endpoint"))
    counted = found.groupBy("run_timestamp").agg(F.countDistinct("endpoint").alias("n"))
    return counted.filter(F.col("n") == len(endpoints)).select("run_timestamp")


def _required(array: Column, name: str) -> Column:
    return F.coalesce(array, F.raise_error(F.lit(f"document has no array {name!r}")))


def _spread(documents: DataFrame, records: Column) -> DataFrame:
    """One row per element of ``records``, dealt over all tasks by its place in the document.

    One task parses a document whatever its length, so what follows must not stay there. Places are
    no content: equal records do not meet.
    """
    placed = documents.select(F.posexplode(records).alias("_at", "_record"))
    return placed.repartition("_at").select("_record")


def tagged_records(documents: DataFrame) -> DataFrame:
    """``table`` and ``record`` of all silver tables in bootstrap documents, from one parse of each.

    A missing array fails the job.
    """
    schema = ", ".join(f"`{name}` array<string>" for name in BOOTSTRAP_ARRAYS.values())
    parsed = documents.select(F.from_json("value", schema, STRICT).alias("value"))

    def tagged(table: str, name: str) -> Column:
        array = _required(F.col("value")[name], name)
        return F.transform(array, lambda r: F.struct(F.lit(table).alias("table"), r.alias("record")))

    every = F.concat(*[tagged(table, name) for table, name in BOOTSTRAP_ARRAYS.items()])
    return _spread(parsed, every).select("_record.*")


def bootstrap_records(documents: DataFrame, table: str) -> DataFrame:
    """Records of one silver table out of bootstrap documents. A missing array fails the job."""
    name = BOOTSTRAP_ARRAYS[table]
    parsed = F.from_json("value", f"`{name}` array<string>", STRICT)
    return _spread(documents, _required(parsed[name], name)).withColumnRenamed("_record", "record")


def array_records(documents: DataFrame) -> DataFrame:
    """Records of documents that are a top-level array."""
    parsed = F.from_json("value", "array<string>", STRICT)
    return _spread(documents, _required(parsed, "top level")).withColumnRenamed("_record", "record")


def history_records(documents: DataFrame, **parent: str) -> DataFrame:
    """Records of the ``history`` array of player documents.

    A document without ``history`` gives no rows; ``"history": null`` fails. ``parent`` maps an
    output column to a number field of the document, e.g. ``player_id="element_id"``; a document
    that has none fails.
    """
    carried = [f"`{field}` bigint" for field in parent.values()]
    parsed = documents.select(
        "value",
        F.from_json("value", ", ".join(["history array<string>", *carried]), STRICT).alias("doc"),
    )
    history = F.col("doc.history")
    declared = F.array_contains(F.json_object_keys("value"), "history")
    rows = (
        F.when(history.isNotNull(), history)
        .when(declared, F.raise_error(F.lit("history is not an array")))
        .otherwise(F.array().cast("array<string>"))
    )
    columns = [
        F.coalesce(F.col("doc")[field], F.raise_error(F.lit(f"document has no {field}")).cast("bigint")).alias(name)
        for name, field in parent.items()
    ]
    return parsed.select(*columns, F.explode(rows).alias("record"))


def element_ids(bootstrap_documents: DataFrame) -> DataFrame:
    """Ids of all players named by the bootstrap documents."""
    players = bootstrap_records(bootstrap_documents, "players")
    return players.select(F.from_json("record", "id bigint", STRICT)["id"].alias("element_id"))


def landed_ids(summary_documents: DataFrame) -> DataFrame:
    parsed = F.from_json("value", "element_id bigint", STRICT)
    return summary_documents.select(parsed["element_id"].alias("element_id"))


def tag_documents(documents: DataFrame, id_column: str = "element_id") -> DataFrame:
    """Player documents that carry the id they were fetched for, ready to land."""
    tag = {"element_id": F.col(id_column).cast("variant")}
    return documents.select(with_fields(F.col("value"), tag).alias("value"))


def as_documents(rows: DataFrame, fields: Mapping[str, Column] | None = None) -> DataFrame:
    """Render rows as one-line JSON documents, e.g. to land a snapshot. NULL fields stay as null."""
    columns = [c.alias(n) for n, c in fields.items()] if fields else rows.columns
    return rows.select(
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")
    )
