"""What an artifact must look like, which settings hold, and small predicates on JSON documents."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Schemas in their order of declaration.
SCHEMAS = (
    "SourcesPack_v1", "TruthPack_v1", "ImpliedExpectations_v1", "CatalystDetection_v1", "ForensicDetection_v1", "AgentReport_v1", "DecisionPacket_v2", "DecisionPacket_v1",
    "MonitoringUpdate_v1", "OutcomeRecord_v1", "CalibrationReport_v1", "ScannerReport_v1", "BenchmarkComparisons_v1", "VotingRecord_v1", "StepVote_v1", "VoteEvent_v1",
    "ModelQualityRollup_v1", "ModelQualityCase_v1", "CandidateList_v2", "PreFilterUniverse_v1", "BullPayload_v1", "CatalystPayload_v1", "ForensicPayload_v1", "RedTeamPayload_v1",
    "PatchBundle_v3", "RemediationPlan_v1", "OrchestratorDirective_v1", "ArbitroRemediateKickoff_v1", "DecisionPacketRef_v1",
)
# Steps, and the schemas of what they may put out, the primary one first.
STEP_SCHEMAS = {
    "SOURCES_COMPILER": ("SourcesPack_v1",), "TP_VALIDATOR": ("TruthPack_v1",), "IMPLIED": ("ImpliedExpectations_v1",), "CATALYST_DETECTION": ("CatalystDetection_v1",),
    "CATALYST_SCORING": ("AgentReport_v1",), "FORENSIC_DETECTION": ("ForensicDetection_v1",), "FORENSIC_SCORING": ("AgentReport_v1",), "BULL": ("AgentReport_v1",),
    "RED_TEAM": ("AgentReport_v1",), "ARBITRO": ("DecisionPacket_v2", "ArbitroRemediateKickoff_v1"), "MONITOR": ("MonitoringUpdate_v1",), "SCANNER": ("ScannerReport_v1",),
}
# Fields and their JSON types that detection steps must have.
DETECTION_SHAPES = {
    "CATALYST_DETECTION": {"caso_id": "string", "fecha_corte": "string", "claims_list": "array", "catalyst_candidates": "array"},
    "FORENSIC_DETECTION": {"caso_id": "string", "fecha_corte": "string", "red_flags": "array", "liquidez": "object", "puentes": "object", "kill_criteria_candidatos": "array"},
}
# Balance-sheet keys that describe rather than state.
BALANCE_METADATA = (
    "escala", "scale", "source_filing", "filing_type", "periodo", "fecha_fin", "fecha_corte", "moneda", "currency", "fuente_refs", "tipo_periodo", "duracion", "is_preliminary",
)


def infer_schema(stem: Column, longest: bool = False) -> Column:
    """The schema whose name a file's stem starts with: the first declared, or the longest."""
    names = sorted(SCHEMAS, key=len, reverse=True) if longest else SCHEMAS
    return F.coalesce(*[F.when(stem.startswith(n), F.lit(n)) for n in names])


def allowed_schemas(step: Column) -> Column:
    """The schemas a step may put out; none for unknown steps."""
    table = F.create_map(*[x for k, v in STEP_SCHEMAS.items() for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])
    return F.coalesce(F.try_element_at(table, step), F.array().cast("array<string>"))


def json_type(doc: Column, key: str) -> Column:
    """string, number, boolean, array, object or null of a document's field; no value where it is missing."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), f"$['{key}']", "variant"))
    return (
        F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
        .when(kind.startswith("ARRAY"), "array").when(kind.startswith("OBJECT"), "object").when(kind.isNotNull(), "number")
    )


def is_object(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(doc)).startswith("OBJECT"), F.lit(False))


def shape_errors(doc: Column, shape: dict[str, str]) -> Column:
    """One error for each required field that is missing or of another type, in the shape's order."""
    each = []
    for key, want in shape.items():
        got = json_type(doc, key)
        each.append(F.when(got.isNull(), F.lit(f"missing required field: {key}")).when(got != want, F.concat(F.lit(f"invalid type for {key}: expected {want}, got "), got)))
    return F.array_compact(F.array(*each))


def transport_envelope(doc: Column) -> Column:
    """A backend's wrapper rather than an artifact."""
    has = lambda k: json_type(doc, k).isNotNull()
    wrapped = (has("result") & (has("modelUsage") | has("type"))) | (has("response") & (has("session_id") | has("stats")))
    return wrapped & ~has("version_esquema")


def candidate_error(step: Column, doc: Column, schemas: dict[str, dict[str, str]]) -> Column:
    """Why a step's output is no artifact; null where it is one.

    Detection steps need their primary tag and shape; others must fit any allowed schema, or, where
    none is declared, be an object of two fields at least.
    """
    n_keys = F.size(F.json_object_keys(doc))
    error = (
        F.when(~is_object(doc), "output is not a JSON object").when(n_keys == 0, "output is an empty JSON object")
        .when(transport_envelope(doc), "output appears to be backend envelope, not artifact payload")
    )
    tag = F.get_json_object(doc, "$.version_esquema")
    rest = F.when(n_keys < 2, "output does not look like a structured artifact")
    for name, allowed in STEP_SCHEMAS.items():
        if name in DETECTION_SHAPES:
            wrong = F.when(~tag.eqNullSafe(F.lit(allowed[0])), F.concat(F.lit(f"version_esquema mismatch: expected {allowed[0]}, got "), F.coalesce(tag, F.lit("None"))))
            own = F.coalesce(wrong, F.get(shape_errors(doc, DETECTION_SHAPES[name]), F.lit(0)))
        else:
            each = [shape_errors(doc, schemas[s]) for s in allowed if s in schemas]
            fits = F.lit(not each)
            for e in each:
                fits = fits | (F.size(e) == 0)
            firsts = [F.concat(F.lit(f"{s}: "), F.get(e, F.lit(0))) for s, e in zip([s for s in allowed if s in schemas], each)]
            own = F.when(~fits, F.concat(F.lit("schema validation failed ("), F.concat_ws(" | ", *firsts), F.lit(")"))) if each else F.lit(None).cast("string")
        rest = F.when(step == name, own).otherwise(rest)
    return F.when(error.isNotNull(), error).otherwise(rest)


def prefetch_errors(names: Column, required: list[str]) -> Column:
    """What must lie in a case's folder before a run and does not."""
    tests = {
        "SourcesPack": (lambda n: n.startswith("SourcesPack_v1_") & n.endswith(".json"), "No SourcesPack file found"),
        "MarketData": (lambda n: n.contains("market") | n.contains("MarketData"), "No market data found"),
    }
    return F.array_compact(F.array(*[F.when(~F.exists(names, tests[r][0]), F.lit(tests[r][1])) for r in required if r in tests]))


def score_precedence(state: Column, packet: Column) -> Column:
    """P25: the state's score, else the packet's preliminary total, else its older one; numbers only."""
    number = lambda d, *path: F.when(F.schema_of_variant(F.try_variant_get(F.try_parse_json(d), "$." + ".".join(path), "variant")).rlike("^(?:BIGINT|INT|DECIMAL|DOUBLE|FLOAT)"), F.get_json_object(d, "$." + ".".join(path)).try_cast("double"))
    return F.coalesce(number(state, "score"), number(packet, "scoring_preliminar", "total_0_100"), number(packet, "decision_probabilistica", "score_0_100"))


def balance_field(key: Column, kind: Column) -> Column:
    """A key that states a balance: not private, not metadata, not a comparison, not an object."""
    low = F.lower(key)
    return ~key.startswith("_") & ~low.isin(*BALANCE_METADATA) & ~low.startswith("comparativo") & (kind != "object")


def boot_lines(cases: DataFrame, status: str, ticker: str, step: str) -> DataFrame:
    """(status, line): the ticker of every case, with the next step of unfinished ones; missing values show as ?."""
    shown = lambda c: F.coalesce(F.col(c), F.lit("?"))
    line = F.when(F.col(status) == "INCOMPLETO", F.concat(shown(ticker), F.lit(" (next: "), shown(step), F.lit(")"))).otherwise(shown(ticker))
    return cases.select(F.col(status).alias("status"), line.alias("line"))


def event_bucket(kind: Column) -> Column:
    """Filings, new highs or lows, prices, others."""
    return F.when(kind.startswith("FILING"), "filing").when(kind.contains("52W"), "extreme").when(kind.contains("PRICE"), "price").otherwise("other")


def excused(cases: DataFrame, exceptions: DataFrame, keys: list[str]) -> DataFrame:
    """Cases with a flag whether an exception is on file; it turns NEEDS_ACTION into EXCEPTION."""
    flag = exceptions.select(*keys).distinct().withColumn("excused", F.lit(True))
    j = cases.join(flag, keys, "left").withColumn("excused", F.coalesce("excused", F.lit(False)))
    return j.withColumn("status", F.when(F.col("excused") & (F.col("status") == "NEEDS_ACTION"), "EXCEPTION").otherwise(F.col("status")))


def report_lists(cases: DataFrame, status: str, key: str) -> DataFrame:
    """(list, key) of the report's lists, each sorted by key: all cases, and those of each status."""
    lists = F.explode(F.array(F.lit("cases"), F.lower(status)))
    return cases.select(lists.alias("list"), key).orderBy("list", key)


def cache_fresh(ok: Column, age_seconds: Column, ok_ttl: int = 600, fail_ttl: int = 60) -> Column:
    """Whether a cached health check still counts."""
    return age_seconds < F.when(ok, ok_ttl).otherwise(fail_ttl)


def model_selection(raw: Column, profiles: list[str]) -> tuple[Column, Column]:
    """(profiles in order of first mention, errors) of a list of names, numbers, ranges and `all`."""
    known = list(dict.fromkeys(profiles))
    all_ = F.array(*[F.lit(p) for p in known])
    tokens = F.filter(F.split(F.trim(raw), r"[,\s]+"), lambda t: t != "")
    none = F.array().cast("array<string>")

    def number(t: Column, group: int, pattern: str = r"^(\d+)-(\d+)$") -> Column:
        return F.regexp_extract(t, pattern, group).try_cast("int")

    def one(t: Column) -> Column:
        start, end, n = number(t, 1), number(t, 2), number(t, 1, r"^(\d+)$")
        range_ok = (start <= end) & (start >= 1) & (end <= len(known))
        bad = lambda text, x: F.struct(none.alias("found"), F.concat(F.lit(text), x).alias("error"))
        good = lambda a: F.struct(a.alias("found"), F.lit(None).cast("string").alias("error"))
        return (
            F.when(F.lower(t) == "all", good(all_))
            .when(t.rlike(r"^\d+-\d+$"), F.when(start > end, bad("range starts after its end: ", t)).when(range_ok, good(F.slice(all_, F.greatest(start, F.lit(1)), F.greatest(end - start + 1, F.lit(0))))).otherwise(bad("number out of range: ", t)))
            .when(t.rlike(r"^\d+$"), F.when(n.between(1, len(known)), good(F.slice(all_, F.greatest(n, F.lit(1)), F.lit(1)))).otherwise(bad("no such number: ", n.cast("string"))))
            .when(F.array_contains(all_, t), good(F.array(t))).otherwise(bad("unknown profile: ", t))
        )

    got = F.transform(tokens, one)
    errors = F.filter(F.transform(got, lambda g: g["error"]), lambda e: e.isNotNull())
    return F.array_distinct(F.flatten(F.transform(got, lambda g: g["found"]))), F.when(F.size(tokens) == 0, F.array(F.lit("nothing was chosen"))).otherwise(errors)


def step_plan(steps: DataFrame, overrides: DataFrame, catalog: DataFrame) -> DataFrame:
    """Steps with their models (the override's, else the default ones), each with its transport; python steps run as themselves."""
    chosen = steps.where(F.col("type").isin("llm", "llm_per_filing", "python")).join(overrides, "step", "left")
    models = F.when(F.col("type") == "python", F.array(F.lit("python"))).otherwise(F.coalesce("override", "models"))
    each = chosen.select("step", "type", models.alias("models"), F.posexplode(models).alias("pos", "model"))
    named = each.join(catalog, "model", "left").withColumn("transport", F.coalesce("transport", "model"))
    by_pos = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("pos", c))), lambda x: x[c])
    out = named.groupBy("step", "type").agg(by_pos("model").alias("models"), by_pos("transport").alias("transports"))
    return out.withColumn("is_multi", F.size("models") > 1)


def dual_lookup(doc: Column, wrapper: str, *keys: str) -> Column:
    """the first key with a value in the document, else in the object that a wrapper key holds."""
    return F.coalesce(*[F.get_json_object(doc, f"$.{k}") for k in keys], *[F.get_json_object(doc, f"$.{wrapper}.{k}") for k in keys])


def ticker_list(raw: Column) -> Column:
    """upper-case tickers of a comma-separated list; blanks go."""
    return F.filter(F.transform(F.split(raw, ","), lambda t: F.upper(F.trim(t))), lambda t: t != "")


def truth(raw: Column) -> Column:
    """whether a setting's text means yes."""
    return F.coalesce(F.lower(F.trim(raw)).isin("1", "true", "yes", "si", "sí", "y"), F.lit(False))


# The extraction request and the universe that every pack carries.
EXTRACTION_PRIORITIES = ("ingresos", "ebit", "net_income", "cfo", "capex", "fcf", "caja", "deuda_total", "acciones_diluidas")
UNIVERSE = {"liquidez_min_usd_dia": 2_000_000, "capitalizacion_min_usd": 300_000_000, "capitalizacion_max_usd": 20_000_000_000}


def with_context_rows(rows: DataFrame) -> DataFrame:
    """rows with the fixed limits and the rank of their field among the extraction priorities."""
    limits = {k: F.lit(v).cast("bigint") for k, v in UNIVERSE.items()}
    return rows.withColumns(limits | {"priority": F.array_position(F.array(*[F.lit(p) for p in EXTRACTION_PRIORITIES]), F.col("field"))})


def failure_path(case: Column, step: Column, at: Column) -> Column:
    """Where a failed step's details are kept."""
    name = F.replace(F.replace(step, F.lit("/"), F.lit("_")), F.lit(" "), F.lit("_"))
    return F.concat(case, F.lit("/_diagnostics/failures/"), name, F.lit("."), F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"), F.lit(".json"))


def stale_partials(files: DataFrame, keep: bool = False) -> DataFrame:
    """The partial files that a new run deletes; none where they are to be kept."""
    return files.where(F.lit(not keep) & F.col("name").rlike(r"^_tmp_tp_filing_.*\.json$")).select("path")


def _shorten(text: str, most: int) -> str:
    if len(text) <= most:
        return text
    return text[: max(0, most)] if most <= 3 else text[: most - 3] + "..."


class _Budget:
    """Spends characters on a document, depth first, keys in order; what is left over is what was not spent."""

    def __init__(self, chars: int, depth: int):
        self.left, self.depth = chars, depth

    def take(self, value, level: int = 0):
        if self.left <= 0:
            return None
        if level > self.depth or not isinstance(value, (dict, list, str, bool, int, float, type(None))):
            value = str(value)
        if isinstance(value, dict):
            out = {}
            for key in sorted(value, key=str):
                cost = len(str(key)) + 2
                if self.left <= 0 or cost >= self.left:
                    break
                self.left -= cost
                out[str(key)] = self.take(value[key], level + 1)
                self.left -= cost  # a key is charged before and after its value
            self.left = max(0, self.left)
            return out
        if isinstance(value, list):
            out = []
            for item in value:
                if self.left <= 0:
                    break
                out.append(self.take(item, level + 1))
            return out
        if isinstance(value, str):
            value = _shorten(value, self.left)
        self.left = max(0, self.left - len(str(value)))
        return value


def compact(doc: Column, chars: int = 1800, depth: int = 6) -> Column:
    """a JSON document cut to a budget of characters; deeper levels become text; null for what is no JSON."""

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for docs in parts:
            yield docs.map(one)

    def one(text):
        try:
            value = json.loads(text)
        except (TypeError, ValueError):
            return None
        got = _Budget(chars, depth).take(value)
        return json.dumps(got if isinstance(got, dict) else {"value": got}, ensure_ascii=False, separators=(",", ":"))

    return F.pandas_udf(run, "string")(doc)
