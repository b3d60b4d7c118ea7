"""Jobs and registered queries."""


def _load() -> None:
    from catloom.plans import queries_enrich, queries_lineage, queries_scalars, queries_select  # noqa: F401


def all_queries():
    from catloom.plans.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from catloom.plans.registry import ORACLES

    _load()
    return dict(ORACLES)
