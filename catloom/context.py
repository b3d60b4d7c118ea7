"""Run settings and wire names shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class WireNames:
    """Names of entity types and attributes on the wire.

    ``product`` is the token of the BI product: it prefixes the product's own
    entity types (``BiQuestion``) and attributes (``biQueryType``).
    ``lookup`` prefixes the identity fields a catalog resolver reads.
    """

    product: str = "bi"
    lookup: str = "ref"

    @property
    def _type_prefix(self) -> str:
        return self.product[:1].upper() + self.product[1:]

    @property
    def collection(self) -> str:
        return f"{self._type_prefix}Collection"

    @property
    def dashboard(self) -> str:
        return f"{self._type_prefix}Dashboard"

    @property
    def question(self) -> str:
        return f"{self._type_prefix}Question"

    @property
    def bi_process(self) -> str:
        return "BIProcess"

    def attr(self, suffix: str) -> str:
        """Product attribute, e.g. ``attr("QueryType")`` -> ``biQueryType``."""
        return f"{self.product}{suffix}"

    def lookup_attr(self, suffix: str) -> str:
        """Resolver attribute, e.g. ``lookup_attr("Identity")`` -> ``refIdentity``."""
        return f"{self.lookup}{suffix}"

    @property
    def entity_types(self) -> tuple[str, ...]:
        return (self.collection, self.dashboard, self.question, self.bi_process)


@dataclass(frozen=True)
class RunContext:
    """Connection and run identity. The clock is an argument, so runs repeat exactly."""

    connection_qn: str = ""
    connection_name: str = ""
    connector_name: str = "bi"
    workflow_id: str = ""
    run_id: str = ""
    run_at_ms: int = 0
    tenant_id: str = "default"
    host: str = ""
    names: WireNames = field(default_factory=WireNames)
