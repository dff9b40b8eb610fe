"""Facts and contexts of inline XBRL pages: a parser in Arrow batches; what follows is SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Concepts, and the tags that state them.
CONCEPTS = {
    "revenue": [
        "us-gaap:Revenues", "us-gaap:RevenueFromContractWithCustomerExcludingAssessedTax", "us-gaap:SalesRevenueNet",
        "us-gaap:SalesRevenueGoodsNet", "ifrs-full:Revenue",
    ],
    "net_income": ["us-gaap:NetIncomeLoss", "us-gaap:ProfitLoss", "us-gaap:NetIncomeLossAvailableToCommonStockholdersBasic", "ifrs-full:ProfitLoss"],
    "operating_income": ["us-gaap:OperatingIncomeLoss", "us-gaap:IncomeLossFromContinuingOperations", "ifrs-full:ProfitLossFromOperatingActivities"],
    "cash": ["us-gaap:CashAndCashEquivalentsAtCarryingValue", "us-gaap:CashCashEquivalentsAndShortTermInvestments", "ifrs-full:CashAndCashEquivalents"],
    "total_assets": ["us-gaap:Assets", "ifrs-full:Assets"],
    "total_liabilities": ["us-gaap:Liabilities", "ifrs-full:Liabilities"],
    "equity": ["us-gaap:StockholdersEquity", "us-gaap:StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest", "ifrs-full:Equity"],
    "cfo": ["us-gaap:NetCashProvidedByUsedInOperatingActivities", "ifrs-full:CashFlowsFromUsedInOperatingActivities"],
    "capex": [
        "us-gaap:PaymentsToAcquirePropertyPlantAndEquipment", "us-gaap:PaymentsToAcquireProductiveAssets",
        "ifrs-full:PurchaseOfPropertyPlantAndEquipmentClassifiedAsInvestingActivities",
    ],
    "eps_basic": ["us-gaap:EarningsPerShareBasic", "ifrs-full:BasicEarningsLossPerShare"],
    "eps_diluted": ["us-gaap:EarningsPerShareDiluted", "ifrs-full:DilutedEarningsLossPerShare"],
}


def concept_tags(spark: SparkSession) -> DataFrame:
    """(tag, concept); a tag of several concepts belongs to the first."""
    first: dict[str, str] = {}
    for concept, tags in CONCEPTS.items():
        for t in tags:
            first.setdefault(t, concept)
    return spark.createDataFrame(list(first.items()), "tag string, concept string")


class _Tagged(HTMLParser):
    """Collects contexts and facts; an element's text is that of all it holds, each piece trimmed."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.facts: list[dict] = []
        self.contexts: list[dict] = []
        self.open: list[tuple[str, dict, str]] = []  # (element, record, field) whose text is being collected
        self.context: dict | None = None
        self.segment = False

    def handle_starttag(self, tag: str, attrs) -> None:
        a = dict(attrs)
        if self.segment and self.context is not None:
            self.context["has_segment"] = True
        if tag.endswith("ix:nonfraction"):
            if a.get("name"):
                fact = {"seq": len(self.facts) + 1, "tag": a["name"], "context": a.get("contextref") or "", "scale": a.get("scale"), "sgn": a.get("sign"), "decimals": a.get("decimals"), "ix_id": a.get("id") or "", "raw": ""}
                self.facts.append(fact)
                self.open.append((tag, fact, "raw"))
            return
        name = tag.rpartition(":")[2]
        if name == "context":
            self.context = {"context": a["id"], "instant": None, "start": None, "end": None, "has_segment": False} if a.get("id") else None
        elif name == "segment":
            self.segment = True
        elif self.context is not None and name in ("instant", "startdate", "enddate"):
            field = name.removesuffix("date")
            self.context[field] = self.context[field] or ""
            self.open.append((tag, self.context, field))

    def handle_endtag(self, tag: str) -> None:
        name = tag.rpartition(":")[2]
        if name == "context" and self.context is not None:
            self.contexts.append(self.context)
            self.context = None
        elif name == "segment":
            self.segment = False
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data: str) -> None:
        for _, record, field in self.open:
            record[field] += data.strip()


def _scan(pages: DataFrame, key: str, html: str, schema: str, fields: list[str], rows: Callable[[_Tagged], list[dict]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, got = [], []
            for i, page in enumerate(batch.column(html).to_pylist()):
                p = _Tagged()
                p.feed(page or "")
                p.close()
                found = rows(p)
                at += [i] * len(found)
                got += found
            cols = [pa.array([r[f] for r in got]) if got else pa.array([], pa.string()) for f in fields]
            kinds = {"seq": pa.int64(), "has_segment": pa.bool_()}
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(at, pa.int64())), *[c.cast(kinds.get(f, pa.string())) for f, c in zip(fields, cols)]], names=[key, *fields])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, {schema}")


def ixbrl_facts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, seq, tag, context, scale, sgn, decimals, ix_id, raw) of every numeric fact in document order."""
    fields = ["seq", "tag", "context", "scale", "sgn", "decimals", "ix_id", "raw"]
    return _scan(pages, key, html, "seq bigint, tag string, context string, scale string, sgn string, decimals string, ix_id string, raw string", fields, lambda p: p.facts)


def ixbrl_contexts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, context, instant, start, end, has_segment); of contexts with one id the last counts."""
    fields = ["context", "instant", "start", "end", "has_segment"]
    return _scan(pages, key, html, "context string, instant string, start string, end string, has_segment boolean", fields, lambda p: list({c["context"]: c for c in p.contexts}.values()))
