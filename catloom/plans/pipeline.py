"""The two jobs as compositions of operators."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.context import RunContext
from catloom.functions import variants as V
from catloom.operators import enrich as E
from catloom.operators import entities as N
from catloom.operators import quality as Q
from catloom.operators import selection as S
from catloom.operators.lineage import column_records, parsed_sources, process_record, with_process_names
from catloom.operators.resolve import resolve_refs
from catloom.plans.stages import Stages
from catloom.session import shared_folder
from catloom.sources.landing import hydrate, hydrate_queries, unwrap_responses


@dataclass(frozen=True)
class Landed:
    """Input of the metadata job.

    The first four are ``(raw, seq)`` rows; the details are landed responses.
    ``lost`` holds failure rows of what was landed before.
    """

    collections: DataFrame
    dashboards: DataFrame
    questions: DataFrame
    databases: DataFrame
    dashboard_details: DataFrame
    question_queries: DataFrame
    lost: DataFrame | None = None

    @classmethod
    def from_responses(
        cls,
        collections: DataFrame,
        dashboards: DataFrame,
        questions: DataFrame,
        databases: DataFrame,
        dashboard_details: DataFrame,
        question_queries: DataFrame,
    ) -> Landed:
        """From landed list responses; lists that failed are in ``lost``."""
        lists = [
            unwrap_responses(collections, "collection"),
            unwrap_responses(dashboards, "dashboard"),
            unwrap_responses(questions, "question"),
            unwrap_responses(databases, "database", envelope="data"),
        ]
        lost = reduce(DataFrame.unionByName, [failed for _, failed in lists])
        return cls(*[rows for rows, _ in lists], dashboard_details, question_queries, lost)


class Catalog:
    """Output of the metadata job. Each part is worked out when it is first asked for."""

    def __init__(self, landed: Landed, selection: S.Selection, ctx: RunContext, root: str):
        self._ctx = ctx
        at = self._stages = Stages(
            landed.collections.sparkSession,
            root,
            {
                "collections": lambda: S.filter_collections(E.typed_collections(landed.collections, ctx.host), selection),
                "summaries": lambda: S.cascade(E.typed_summaries(landed.dashboards), S.accepted_ids(at["collections"])),
                "wanted_questions": lambda: S.cascade(E.typed_questions(landed.questions, ctx.host), S.accepted_ids(at["collections"])),
                "databases": lambda: S.databases(E.typed_databases(landed.databases)),
                # Scope first: details are read only for what the cascade keeps.
                "dashboards": lambda: E.with_collection(
                    E.typed_dashboards(hydrate(at["summaries"], landed.dashboard_details, "dashboard")[0].select("raw", "seq"), ctx.host),
                    at["collections"],
                ),
                "slots": lambda: E.card_slots(at["dashboards"]),
                "question_context": lambda: E.query_context(
                    E.with_collection(at["wanted_questions"], at["collections"]),
                    hydrate_queries(at["wanted_questions"], landed.question_queries)[0],
                    at["databases"],
                ),
                "questions": lambda: E.with_dashboard_count(self.question_context, at["slots"]),
                "questions_dashboards": lambda: E.edges(self.question_context, E.card_dashboards(at["slots"]), ctx),
                "residuals": lambda: reduce(
                    DataFrame.unionByName,
                    [
                        *([landed.lost] if landed.lost is not None else []),
                        hydrate(at["summaries"], landed.dashboard_details, "dashboard")[1],
                        hydrate_queries(at["wanted_questions"], landed.question_queries)[1],
                    ],
                ),
            },
        )

    collections = property(lambda self: self._stages["collections"])
    dashboards = property(lambda self: self._stages["dashboards"])
    questions = property(lambda self: self._stages["questions"])
    edges = property(lambda self: self._stages["questions_dashboards"])
    residuals = property(lambda self: self._stages["residuals"])

    @property
    def question_context(self) -> DataFrame:
        """The questions before their dashboards are counted."""
        return self._stages["question_context"].filter("known").drop("known")

    @property
    def rejected(self) -> DataFrame:
        return self._stages["question_context"].filter("NOT known").select("id", "name")

    @property
    def entities(self) -> DataFrame:
        self._stages.together("dashboards", "question_context")
        self._stages.together("questions", "questions_dashboards")
        return N.all_entities(
            N.entity_collections(self.collections, self._ctx),
            N.entity_dashboards(self.dashboards, self._ctx),
            N.entity_questions(self.questions, self._ctx),
            N.entity_bi_process(self.edges, self._ctx),
        )

    @property
    def totals(self) -> dict[str, int]:
        """Rows after filtering and after enrichment, as the writes of the stages counted them.

        A total whose stages no output asked for is left out; nothing is run for it.
        """
        found = {
            "filter": self._stages.total("collections", "summaries", "wanted_questions", "databases"),
            "enrich": self._stages.total("collections", "dashboards", "questions", "questions_dashboards"),
        }
        return {k: n for k, n in found.items() if n is not None}


def run_metadata(
    landed: Landed,
    selection: S.Selection,
    ctx: RunContext,
    stage_root: str | None = None,
) -> Catalog:
    """Landed records to catalog entities.

    Stages are written as Parquet below ``stage_root`` (a new shared folder without it),
    each once and only if an output that is asked for needs it.
    """
    root = stage_root or shared_folder(landed.collections.sparkSession, "metadata")
    return Catalog(landed, selection, ctx, root)


def run_preflight(
    collections: DataFrame, dashboards: DataFrame, questions: DataFrame, databases: DataFrame, selection: S.Selection
) -> tuple[DataFrame, DataFrame]:
    """Readiness from landed list responses: the checks, ``(name, n, passed)``, and the verdict.

    A check passes if its list landed whole, whatever it counts; the permission check
    also needs that nothing is missing. Dashboards and questions need the
    collections too. A list that did not land has no count.
    """
    lists = {
        "collections": (collections, *unwrap_responses(collections, "collection")),
        "permissions": (databases, *unwrap_responses(databases, "database", envelope="data")),
        "dashboards": (dashboards, *unwrap_responses(dashboards, "dashboard")),
        "questions": (questions, *unwrap_responses(questions, "question")),
    }

    def field(name: str, key: str) -> DataFrame:
        return lists[name][1].select(Q.landed_key(F.col("raw"), key).alias(key), V.at(F.col("raw"), "$.personal_owner_id").alias("personal_owner_id"))

    counts = Q.preflight_counts(
        field("collections", "id"),
        field("dashboards", "collection_id"),
        field("questions", "collection_id"),
        E.typed_databases(lists["permissions"][1]),
        selection,
    )

    def evidence(check: str, name: str) -> DataFrame:
        given, _, lost = lists[name]
        landed, failed = given.select(F.lit(1).alias("landed"), F.lit(0).alias("failed")), lost.select(F.lit(0), F.lit(1))
        return landed.union(failed).agg(
            F.lit(check).alias("name"), F.coalesce((F.sum("landed") > 0) & (F.sum("failed") == 0), F.lit(False)).alias("whole")
        )

    needs = [*((n, n) for n in lists), ("dashboards", "collections"), ("questions", "collections")]
    whole = reduce(DataFrame.unionByName, [evidence(*n) for n in needs]).groupBy("name").agg(F.bool_and("whole").alias("whole"))
    checks = counts.join(whole, "name").select(
        "name",
        F.when(F.col("whole"), F.col("n")).alias("n"),
        (F.col("whole") & ((F.col("name") != "permissions") | (F.col("n") == 0))).alias("passed"),
    )
    return checks, Q.readiness(checks)


def with_connection(ctx: RunContext, connection: dict | None) -> RunContext:
    """Fill a missing qualified name from the connection's own attributes; a
    missing name falls back to the connector's."""
    from dataclasses import replace

    attributes = (connection or {}).get("attributes") or {}
    return replace(
        ctx,
        connection_qn=ctx.connection_qn or attributes.get("qualifiedName") or "",
        connection_name=ctx.connection_name or attributes.get("name") or ctx.connector_name,
    )


def run_lineage(
    parsed: DataFrame, ctx: RunContext, catalog: DataFrame | None = None, default_vendor: str = "", stage_root: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Parsed-SQL records to processes and column processes, resolved against a
    catalog table when one is given.

    The records are parsed once, into a stage below ``stage_root`` (a new shared folder
    without it); everything else reads the stage. Names, which hold hashes, are no part of
    it: hashes do not compress.
    """
    root = stage_root or shared_folder(parsed.sparkSession, "lineage-parsed")
    stages = Stages(parsed.sparkSession, root, {"parsed": lambda: parsed_sources(parsed, default_vendor)})
    named = with_process_names(stages["parsed"], ctx)
    tables, columns = named.select(*process_record(ctx)), column_records(named, ctx)
    if catalog is None:
        return tables, columns
    return resolve_refs(tables, catalog, ctx), resolve_refs(columns, catalog, ctx)
