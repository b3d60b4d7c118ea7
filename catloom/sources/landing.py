"""Landed API responses: unwrapping, hydration, and the rows that failed.

A landed response is ``(endpoint, record_id, http_status, body)`` with the body
as text, plus ``seq``. Nothing here calls a server.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catloom.functions import variants as V
from catloom.functions.binding import bind
from catloom.functions.ordering import for_join, last_wins
from catloom.sources.bodies import PARSER_HOLDS, cut_bodies

# Failure categories.
LIST_FAILED = {
    "collection": "collections_fetch_failed",
    "dashboard": "dashboards_fetch_failed",
    "question": "questions_fetch_failed",
    "database": "databases_fetch_failed",
}
DETAIL_FAILED = {
    "dashboard": "dashboard_detail_fetch_failed",
    "database": "database_metadata_fetch_failed",
}
QUERY_FAILED = "question_query_fetch_failed"
QUERY_ERRORED = "question_query_fetch_errored"

#: Category of what landed whole but is more than the JSON parser holds.
OVERSIZE = "oversize"

RESIDUAL_COLUMNS = ("timestamp", "category", "endpoint", "record_id", "http_status", "length")


def succeeded(status: Column) -> Column:
    return F.coalesce(status.try_cast("int").between(200, 299), F.lit(False))


def residuals(rejects: DataFrame, category: Column | str, at: Column | None = None) -> DataFrame:
    """Failure rows. Detail columns that are missing become null, as does a
    status that is not a number. ``length`` is given for what is oversize."""

    def detail(name: str, kind: str) -> Column:
        return (F.col(name).try_cast(kind) if name in rejects.columns else F.lit(None).cast(kind)).alias(name)

    label = F.lit(category) if isinstance(category, str) else category
    return rejects.select(
        (F.current_timestamp() if at is None else at).cast("timestamp").alias("timestamp"),
        label.alias("category"),
        detail("endpoint", "string"),
        detail("record_id", "string"),
        detail("http_status", "int"),
        detail("length", "long"),
    )


def append_residuals(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def _too_long(body: Column, holds: int = PARSER_HOLDS) -> Column:
    return F.coalesce(F.octet_length(body) > holds, F.lit(False))


def _failure(category: Column | str, succeeded: Column | None = None) -> list[Column]:
    """Category and length of a body that was not read: oversize if it landed and is longer than the parser must hold."""
    other = F.lit(category) if isinstance(category, str) else category
    lost = _too_long(F.col("body"))
    lost = lost if succeeded is None else lost & succeeded
    return [F.when(lost, F.lit(OVERSIZE)).otherwise(other).alias("category"), F.when(lost, F.octet_length("body")).alias("length")]


def unwrap_responses(
    landed: DataFrame, kind: str, envelope: str | None = None, holds: int = PARSER_HOLDS
) -> tuple[DataFrame, DataFrame]:
    """One row per element of the landed list, ``(raw, seq)``, and the failures.

    With ``envelope`` the list sits under that key; a bare list is accepted too,
    and any other body gives no rows. A body of more than ``holds`` bytes is cut into
    its elements first; an element that the parser still does not hold is one failure,
    ``oversize`` with its length.
    """
    ok = succeeded(F.col("http_status"))
    # The parts of seq travel as plain columns: Spark cannot take fields of a struct
    # through two generators.
    others = [c for c in landed.columns if c != "seq"]
    told = [c for c in others if c != "body"]
    place = ("source", "block", "row")
    seq = F.struct(*[F.col(f"_{f}").alias(f) for f in place], F.col("_item").alias("item")).alias("seq")
    flat = landed.filter(ok).select(*others, *[F.col(f"seq.{f}").alias(f"_{f}") for f in place])
    body = bind(flat.filter(~_too_long(F.col("body"), holds)), _body=V.parse(F.col("body")))
    items = V.elements(F.col("_body"))
    if envelope:
        items = F.coalesce(items, V.elements(F.col("_body"), f"$.{envelope}"))
    exploded = body.select(*[f"_{f}" for f in place], F.posexplode(items).alias("_item", "raw"))
    cut = cut_bodies(flat.filter(_too_long(F.col("body"), holds)), envelope).withColumnRenamed("item", "_item")
    cut = bind(cut, raw=V.parse(F.col("text")))
    rows = exploded.select("raw", seq).unionByName(cut.filter(F.col("raw").isNotNull()).select("raw", seq))
    unreadable = body.filter(F.col("_body").isNull()).select(*told)
    unreadable = unreadable.unionByName(cut.filter(F.col("_item").isNull()).select(*told))
    failed = residuals(landed.filter(~ok).select(*told).unionByName(unreadable), LIST_FAILED[kind])
    lost = cut.filter(F.col("_item").isNotNull() & F.col("raw").isNull()).select(*told, "length")
    return rows, failed.unionByName(residuals(lost, OVERSIZE))


def detail_worklist(summaries: DataFrame, ident: str = "id") -> DataFrame:
    """Summaries whose id is present and not 0 or empty."""
    key = F.col(ident).cast("string")
    return summaries.filter(key.isNotNull() & ~key.isin("0", ""))


def query_worklist(questions: DataFrame) -> DataFrame:
    """Questions with an id and a non-empty ``dataset_query`` (VARIANT)."""
    return questions.filter(F.col("id").isNotNull() & V.is_given(F.col("dataset_query"), "$"))


def _latest_response(landed: DataFrame, wanted: DataFrame, ident: str) -> DataFrame:
    """Latest response of each wanted record; bodies out of scope are left behind first.

    The scope joins by the two columns that ``last_wins`` groups by, so one shuffle
    serves both, and the result gets its own for the join after it.
    """
    given = landed.select(F.col("record_id").cast("string").alias("record_id"), "endpoint", "http_status", "body", "seq")
    scope = wanted.select(F.col(ident).alias("_wanted")).groupBy("_wanted", for_join("_wanted")).agg(F.lit(1).alias("_one"))
    same = (F.col("record_id") == F.col("_wanted")) & (for_join("record_id") == F.col("_half"))
    return last_wins(given.join(scope, same, "left_semi"), "record_id").drop("seq")


def hydrate(summaries: DataFrame, landed: DataFrame, kind: str, ident: str = "id") -> tuple[DataFrame, DataFrame]:
    """Detail record of every summary, ``(id, raw, seq)``, and the failures.

    A failed, unreadable or missing response costs that one record; one beyond what
    the parser holds is named ``oversize``.
    """
    wanted = detail_worklist(summaries, ident).select(F.col(ident).cast("string").alias("id"), "seq")
    got = _latest_response(landed, wanted, "id")
    joined = bind(
        wanted.join(got, wanted["id"] == got["record_id"], "left"),
        raw=F.when(succeeded(F.col("http_status")), V.parse(F.col("body"))),
    )
    rows = joined.filter(F.col("raw").isNotNull()).select("id", "raw", "seq")
    failed = joined.filter(F.col("raw").isNull()).select(
        *_failure(DETAIL_FAILED[kind], succeeded(F.col("http_status"))), "endpoint", F.col("id").alias("record_id"), "http_status"
    )
    return rows, residuals(failed, F.col("category"))


def query_text(v: Column, json_path: str = "$.query") -> Column:
    """Resolved query; a value that is not text becomes empty."""
    is_text = V.json_text(v, json_path).startswith('"')
    return F.when(is_text, V.at(v, json_path)).otherwise(F.lit(""))


def hydrate_queries(questions: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resolved SQL per question, ``(question_id, query, params, seq)``, and the failures.

    A response without a query gives neither a row nor a failure.
    """
    wanted = query_worklist(questions).select(F.col("id").cast("string").alias("question_id"), "seq")
    got = _latest_response(landed, wanted, "question_id")
    joined = wanted.join(got, wanted["question_id"] == got["record_id"], "left")
    ok = succeeded(F.col("http_status"))
    joined = bind(joined, _body=F.when(ok, V.parse(F.col("body"))))
    readable = V.fields(F.col("_body")).isNotNull()
    rows = joined.filter(readable & V.is_given(F.col("_body"), "$.query")).select(
        "question_id",
        query_text(F.col("_body")).alias("query"),
        F.nullif(V.json_text(F.col("_body"), "$.params"), F.lit("null")).alias("params"),
        "seq",
    )
    category = F.when(ok, F.lit(QUERY_ERRORED)).otherwise(F.lit(QUERY_FAILED))
    failed = joined.filter(~readable).select(
        *_failure(category, ok & F.col("_body").isNull()),
        "endpoint",
        F.col("question_id").alias("record_id"),
        F.when(~ok, F.col("http_status")).alias("http_status"),
    )
    return rows, residuals(failed, F.col("category"))
