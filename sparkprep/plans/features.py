"""Composite feature engineering as a Spark ML Estimator/Model (EN8-EN12, IO10).

``FeatureEngineer.fit`` gathers every fitted statistic in three
aggregations over the input (rare-level counts; prior and medians; one
long-form level table shared by target encoding and one-hot), and
``FeatureModel.transform`` is a single projection chain (plus the optional
whole-row dedupe shuffle). Fitted state is small tables, persisted as
Parquet next to the ML metadata, so the model survives a save/load round
trip and can be a stage of ``pyspark.ml.Pipeline``.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import long_form, q
from ..operators import clean as C
from ..operators import encode as E


@dataclass
class FeatureSpec:
    target: str
    te_cols: list[str] = field(default_factory=list)
    ohe_cols: list[str] = field(default_factory=list)
    numeric_cols: list[str] = field(default_factory=list)
    drop_cols: list[str] = field(default_factory=list)
    placeholder: str | None = "Select"
    value_maps: dict[str, dict] = field(default_factory=dict)  # col -> {"map": {...}, "default": v}
    sequential_maps: bool = False  # CL5 instead of CL4
    fills: dict[str, object] = field(default_factory=dict)
    rare_col: str | None = None
    rare_min_count: int = 10
    rare_min_share: float | None = None  # threshold as a share of rows instead of a count
    rare_other: str = "Others"
    rare_before_fill: bool = True
    median_scope: str = "fit"  # fit | batch
    median_relative_error: float | None = None  # None = exact
    encoding: str = "smoothed"  # smoothed | mean | none
    min_samples_leaf: float = 20
    smoothing: float = 10.0
    fit_order: str = "canonical"  # canonical | encode_before_fill
    one_hot: str = "fitted"  # fitted | indexed | batch | none
    one_hot_null: str = "zero"  # zero | skip (indexed only)
    dedupe: bool = False  # whole-row dedupe inside transform
    sanitize: bool = False
    conditional_drop: dict | None = None  # {"col":..., "value":..., "min_share":...}
    keep_target: bool = True


@dataclass
class FittedState:
    rare_levels: list = field(default_factory=list)
    prior: float | None = None
    medians: dict = field(default_factory=dict)
    one_hot_levels: dict = field(default_factory=dict)
    one_hot_passthrough: list = field(default_factory=list)
    dropped_conditional: list = field(default_factory=list)


# --------------------------------------------------------------------------- shared steps


def _prepare(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Stateless part: names, placeholder -> null, value maps."""
    if spec.sanitize:
        df = C.sanitize_columns(df)
    if spec.placeholder is not None:
        df = C.placeholders_to_null(df, spec.placeholder)
    for col, m in spec.value_maps.items():
        if col in df.columns:
            df = C.map_values(df, col, m.get("map", {}), m.get("default"), sequential=spec.sequential_maps)
    return df


def _fill(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return C.fill_constant(df, {c: v for c, v in spec.fills.items() if c in df.columns})


def _group_rare(df: DataFrame, spec: FeatureSpec, levels: list) -> DataFrame:
    if spec.rare_col and spec.rare_col in df.columns:
        return C.group_rare_list(df, spec.rare_col, levels, spec.rare_other)
    return df


def _materialize(stats: DataFrame) -> DataFrame:
    """Compute a frame that is read again once, in the shared checkpoint folder."""
    from ..session import cut_lineage

    return cut_lineage(stats)


class FeatureEngineer(Estimator, MLReadable, MLWritable):
    """EN9 (canonical), EN10 (``fit_order='encode_before_fill'``), EN11 (table job preset)."""

    def __init__(self, spec: FeatureSpec | None = None):
        super().__init__()
        self.spec = spec

    def _fit(self, df: DataFrame) -> "FeatureModel":
        spec = self.spec
        C.require_non_empty(df)
        C.require_columns(df, [spec.target])
        if spec.dedupe:  # the table job drops repeated rows before every statistic
            df = C.drop_duplicates(C.sanitize_columns(df) if spec.sanitize else df)
            return self._fit_tables(_prepare(df, FeatureSpec(**{**asdict(spec), "sanitize": False})))
        return self._fit_tables(_prepare(df, spec))

    def _fit_tables(self, x: DataFrame) -> "FeatureModel":
        """Level statistics stay frames. What reaches the driver is the prior, a
        median per column, the one-hot levels (they become the schema) and the
        rare levels (they are part of the model's state)."""
        spec = self.spec
        st = FittedState()
        # the fit reads its input several times: what it needs of the prepared rows is written once
        used = {spec.target, spec.rare_col, *spec.numeric_cols, *spec.te_cols, *spec.ohe_cols, *spec.fills, (spec.conditional_drop or {}).get("col")}
        x = _materialize(x.select(*[q(c) for c in x.columns if c in used]))

        # 1. rare levels (nulls never a level)
        if spec.rare_col:
            base = x if spec.rare_before_fill else _fill(x, spec)
            thr = spec.rare_min_count
            if spec.rare_min_share is not None:
                thr = spec.rare_min_share * base.count()
            st.rare_levels = sorted(r["level"] for r in C.rare_levels(base, spec.rare_col, thr).collect())  # bounded: rare levels

        encode_input = x if spec.fit_order == "encode_before_fill" else _group_rare(_fill(x, spec), spec, st.rare_levels)
        filled = _group_rare(_fill(x, spec), spec, st.rare_levels)

        # 2. prior and medians
        nums = [c for c in spec.numeric_cols if c in filled.columns]
        st.prior = filled.agg(F.avg(q(spec.target).cast("double")).alias("p")).first()["p"]
        if spec.median_scope == "fit":
            st.medians = C.medians(filled, nums, spec.median_relative_error)

        # 3. one long-form level table for target encoding and one-hot
        te = [c for c in spec.te_cols if c in encode_input.columns] if spec.encoding != "none" else []
        oh = [c for c in spec.ohe_cols if c in filled.columns] if spec.one_hot in ("fitted", "indexed") else []
        stats = None
        if te:
            lf = long_form(encode_input, te, ids=[spec.target], val="level")
            stats = (lf.filter(F.col("level").isNotNull()).groupBy("column_name", "level")
                     .agg(F.count(F.lit(1)).alias("n"), F.avg(q(spec.target).cast("double")).alias("target_mean")))
            if spec.encoding == "smoothed":
                stats = stats.withColumn("encoded", E.smoothed_value(F.col("n"), F.col("target_mean"), st.prior,
                                                                     spec.min_samples_leaf, spec.smoothing))
            else:
                stats = stats.withColumn("encoded", F.col("target_mean"))
            stats = _materialize(stats.select("column_name", "level", "n", "target_mean", "encoded"))
        if oh:
            fitted = (E.one_hot_fit(filled, oh) if spec.one_hot == "fitted"
                      else E.one_hot_indexed_fit(filled, oh, spec.one_hot_null))
            st.one_hot_levels = fitted.levels
            st.one_hot_passthrough = fitted.passthrough
        if spec.conditional_drop:
            cd = spec.conditional_drop
            if cd["col"] in filled.columns:
                share = C.value_share(filled, cd["col"], cd["value"])
                if share is None or share < cd["min_share"]:
                    st.dropped_conditional = [cd["col"]]
        return FeatureModel(spec, st, stats)

    def copy(self, extra=None):
        return FeatureEngineer(self.spec)

    def write(self):
        return _SpecWriter(self)

    @classmethod
    def read(cls):
        return _SpecReader(cls)


class FeatureModel(Model, MLReadable, MLWritable):
    def __init__(self, spec: FeatureSpec | None = None, state: FittedState | None = None,
                 te_stats: DataFrame | None = None):
        super().__init__()
        self.spec = spec
        self.state = state
        self.te_stats = te_stats

    def output_columns(self, df: DataFrame) -> list[str]:
        return self.transform(df.limit(0)).columns

    def _transform(self, df: DataFrame) -> DataFrame:
        spec, st = self.spec, self.state
        x = df
        if spec.dedupe:
            x = C.drop_duplicates(C.sanitize_columns(x) if spec.sanitize else x)
            spec_no_sanitize = FeatureSpec(**{**asdict(spec), "sanitize": False})
            x = _prepare(x, spec_no_sanitize)
        else:
            x = _prepare(x, spec)
        x = _fill(x, spec)
        nums = [c for c in spec.numeric_cols if c in x.columns]
        if spec.median_scope == "batch":
            meds = C.medians(x, nums, spec.median_relative_error)
        else:
            meds = st.medians
        x = C.fill_numeric(x, meds)
        x = _group_rare(x, spec, st.rare_levels)
        if self.te_stats is not None:
            te = [c for c in spec.te_cols if c in x.columns]
            if spec.encoding == "mean":
                x = E.apply_level_values(x, te, self.te_stats, "encoded", None, suffix="_encoded", drop_source=True)
            else:
                x = E.apply_level_values(x, te, self.te_stats, "encoded", st.prior)
        x = C.drop_columns(x, list(spec.drop_cols) + list(st.dropped_conditional))
        if not spec.keep_target and spec.target in x.columns:
            x = x.drop(spec.target)
        if spec.one_hot == "batch":
            x = E.one_hot_batch(x, [c for c in spec.ohe_cols if c in x.columns])
        elif st.one_hot_levels:
            x = E.one_hot_transform(x, E.OneHot(st.one_hot_levels, st.one_hot_passthrough,
                                                spec.one_hot_null if spec.one_hot == "indexed" else "zero"))
            ohe_names = [E.one_hot_name(c, lv) for c, lvs in st.one_hot_levels.items() for lv in lvs]
            x = C.align_columns(x, ohe_names, fill=0.0)
        return x

    def copy(self, extra=None):
        return FeatureModel(self.spec, self.state, self.te_stats)

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)


# --------------------------------------------------------------------------- persistence (IO10)


class _SpecWriter(MLWriter):
    def __init__(self, inst):
        super().__init__()
        self.inst = inst

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.inst, path, self.sparkSession.sparkContext,
                                         extraMetadata={"spec": asdict(self.inst.spec)})


class _SpecReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession.sparkContext)
        inst = self.cls(FeatureSpec(**meta["spec"]))
        inst._resetUid(meta["uid"])
        return inst


class _ModelWriter(MLWriter):
    def __init__(self, inst):
        super().__init__()
        self.inst = inst

    def saveImpl(self, path: str) -> None:
        m = self.inst
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession.sparkContext, extraMetadata={
            "spec": asdict(m.spec), "state": json.loads(json.dumps(asdict(m.state), default=str)),
            "has_stats": m.te_stats is not None})
        if m.te_stats is not None:
            m.te_stats.write.mode("overwrite").parquet(f"{path}/te_stats")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession.sparkContext)
        stats = self.sparkSession.read.parquet(f"{path}/te_stats") if meta.get("has_stats") else None
        inst = self.cls(FeatureSpec(**meta["spec"]), FittedState(**meta["state"]), stats)
        inst._resetUid(meta["uid"])
        return inst


def load_model(spark: SparkSession, path: str) -> FeatureModel:
    """IO10: load a fitted model; a missing path is an error."""
    return FeatureModel.load(path)


# --------------------------------------------------------------------------- presets

# The lead-scoring preset's column roles and value maps.
LEAD_OHE = ["Do Not Email", "A free copy of Mastering The Interview", "Search", "Newspaper Article",
            "X Education Forums", "Newspaper", "Digital Advertisement", "Through Recommendations",
            "What is your current occupation"]
LEAD_TE = ["Lead Source", "Lead Origin", "Last Activity", "Specialization"]
LEAD_DROP = ["Prospect ID", "Lead Number", "How did you hear about X Education", "Lead Profile",
             "Lead Quality", "Asymmetrique Profile Score", "Asymmetrique Activity Score",
             "Asymmetrique Activity Index", "Asymmetrique Profile Index", "Tags",
             "Last Notable Activity", "City", "Country", "What matters most to you in choosing a course",
             "Magazine", "Receive More Updates About Our Courses", "Update me on Supply Chain Content",
             "Get updates on DM Content", "I agree to pay the amount through cheque", "Do Not Call"]
LEAD_NUMERIC = ["TotalVisits", "Page Views Per Visit", "Total Time Spent on Website"]
LEAD_SOURCE_MAP = {
    "google": "Google", "bing": "Search Engine", "Google": "Search Engine", "Organic Search": "Search Engine",
    "Click2call": "Other", "Live Chat": "Other", "Social Media": "Other", "Press_Release": "Other",
    "Pay per Click Ads": "Other", "blog": "Other", "WeLearn": "Other", "welearnblog_Home": "Other",
    "youtubechannel": "Other", "testone": "Other", "NC_EDM": "Other",
}
LEAD_ORIGIN_MAP = {"Lead Import": "Other", "Quick Add Form": "Other"}
LEAD_FILLS = {"Specialization": "Others", "What is your current occupation": "Unknown", "Last Activity": "Email Opened"}


def _snake_list(cols):
    from ..functions.exprs import snake_name
    return [snake_name(c) for c in cols]


def lead_preset(kind: str = "canonical", target: str = "Converted") -> FeatureSpec:
    """Presets reproducing the reference's three feature paths and the minimal cleaner."""
    maps = {"Lead Source": {"map": LEAD_SOURCE_MAP, "default": "Other"},
            "Lead Origin": {"map": LEAD_ORIGIN_MAP, "default": "Other"}}
    if kind == "canonical":
        return FeatureSpec(target=target, te_cols=LEAD_TE, ohe_cols=LEAD_OHE, numeric_cols=LEAD_NUMERIC,
                           drop_cols=LEAD_DROP, value_maps=maps, fills=LEAD_FILLS, rare_col="Last Activity")
    if kind == "full_preprocess":
        return FeatureSpec(target=target, te_cols=LEAD_TE, ohe_cols=LEAD_OHE, numeric_cols=LEAD_NUMERIC,
                           drop_cols=LEAD_DROP, value_maps=maps, fills=LEAD_FILLS, rare_col="Last Activity",
                           fit_order="encode_before_fill", one_hot="none",
                           conditional_drop={"col": "Do Not Call", "value": "Yes", "min_share": 0.01})
    if kind == "table_job":
        snake = {k.lower().replace(" ", "_"): v for k, v in maps.items()}
        return FeatureSpec(target=target.lower(), te_cols=_snake_list(LEAD_TE), ohe_cols=_snake_list(LEAD_OHE),
                           numeric_cols=_snake_list(LEAD_NUMERIC), drop_cols=_snake_list(LEAD_DROP), value_maps=snake,
                           sequential_maps=True, fills={k.lower().replace(" ", "_"): v for k, v in LEAD_FILLS.items()},
                           rare_col="last_activity", median_scope="batch", median_relative_error=0.25,
                           encoding="mean", one_hot="indexed", dedupe=True, sanitize=True)
    if kind == "minimal":
        return FeatureSpec(target=target, encoding="none", one_hot="none", dedupe=True, median_scope="fit")
    raise ValueError(f"unknown preset {kind!r}")


def minimal_clean(df: DataFrame, placeholder: str = "Select") -> DataFrame:
    """EN8: whole-row dedupe + placeholder -> null."""
    return C.placeholders_to_null(C.drop_duplicates(df), placeholder)
