"""From one declarative spec to fitted steps, ranked models and scored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.kinds import col, numeric_columns
from ..operators import evaluate as ev
from ..operators.collinear import Collinear, CollinearModel
from ..operators.encode import Encoder, EncoderModel, LabelEncoder, LabelModel
from ..operators.ensemble import hard_vote, member_weights, soft_vote, weighted_mean
from ..operators.features import PassengerFeatures
from ..operators.impute import Imputer
from ..operators.models import FOLD, LABEL, REGISTRY, FoldCopies, SharedRows, TrainedModel, assemble, train
from ..operators.outliers import OutlierModel, Outliers
from ..operators.reduce import Reducer, ReducerModel
from ..operators.split import add_folds
from ..sources import store
from ..sources.tables import Loader, write_predictions

FEATURE_PRESETS = {"passenger": PassengerFeatures}
PASSENGER_ID = "PassengerId"  # fixed value


@dataclass(frozen=True)
class Variant:
    """Which prepared data one model reads."""

    winsor: bool = False
    decollinear: bool = False
    drop_cols: tuple[str, ...] = ()
    pca: bool = False

    @property
    def label(self) -> str:
        parts = ["winsorized"] if self.winsor else ["original"]
        parts += ["no-collinear"] if self.decollinear else []
        parts += [f"without {c}" for c in self.drop_cols]
        return "+".join(parts + (["pca"] if self.pca else []))


@dataclass(frozen=True)
class Entry:
    """One trained model with the data it reads."""

    key: str
    base: str
    variant: Variant
    model: TrainedModel
    oof_score: float | None = None


@dataclass(frozen=True)
class Vote:
    members: dict[str, float]
    voting: str
    score: float
    skipped: list[str]
    threshold: float = 0.5


@dataclass
class Prepared:
    """Fitted preparation steps, shared by every variant."""

    loader: Loader
    id_col: str
    features: object | None
    imputer: object
    outliers: OutlierModel | None
    collinear: CollinearModel | None
    encoders: dict[tuple[bool, bool], EncoderModel]
    labels: LabelModel
    reducers: dict[Variant, ReducerModel] = field(default_factory=dict)

    def clean(self, df: DataFrame) -> DataFrame:
        """Markers, derived features and imputation, common to all variants."""
        return self.imputer.transform(self.derive(df))

    def derive(self, df: DataFrame) -> DataFrame:
        return df if self.features is None else self.features.transform(df)

    def matrix(self, cleaned: DataFrame, variant: Variant, keep: list[str]) -> DataFrame:
        """Encoded numeric columns of one variant, plus the kept ones."""
        df = cleaned
        if variant.winsor and self.outliers is not None:
            df = self.outliers.transform(df)
        if variant.decollinear and self.collinear is not None:
            df = self.collinear.transform(df)
        encoded = self.encoder(variant).transform(df, keep).drop(*variant.drop_cols)
        return self.reducers[variant].transform(encoded, keep) if variant.pca else encoded

    def encoder(self, variant: Variant) -> EncoderModel:
        if not variant.decollinear:
            return self.encoders[(False, False)]
        return self.encoders[(variant.winsor, True)]

    def vectors(self, cleaned: DataFrame, variant: Variant, keep: list[str]) -> DataFrame:
        wide = self.matrix(cleaned, variant, keep)
        return assemble(wide, [c for c in wide.columns if c not in keep], keep)


# What a spec may say, by section.
KNOWN_KEYS = {
    "loader": ("target_col", "id_col", "train_path", "test_path", "format", "schema", "drop_cols", "drop_missing_thresh",
               "promote_numeric", "multi_line"),
    "feature_engineering": ("enabled", "preset", "drop_cols_for", "drop_raw_fare_for"),
    "cleaner": ("num_strategy", "cat_strategy", "knn_neighbors"),
    "outliers": ("detection", "treatment", "iqr_threshold", "zscore_threshold", "cols", "apply_to"),
    "multicollinearity": ("threshold", "drop", "apply_to"),
    "pca": ("n_components", "apply_to"),
    "encoder": ("num_strategy", "cat_strategy"),
    "models": ("active", "cv", "scoring", "random_state", "tune_threshold", "threshold_scoring", "grid", "grids", "parallelism",
               "shuffle_folds"),
    "model_cache": ("enabled", "path"),
    "ensemble": ("enabled", "voting", "weights", "members"),
    "output": ("submission_dir",),
}


def section(spec: Mapping, name: str) -> Mapping:
    """A section, empty if absent or left blank."""
    return spec.get(name) or {}


def id_of(spec: Mapping) -> str:
    """The id column. A passenger list needn't name it."""
    named = section(spec, "loader").get("id_col")
    if named:
        return named
    fe = section(spec, "feature_engineering")
    if fe.get("enabled") and fe.get("preset", "passenger") == "passenger":
        return PASSENGER_ID
    raise ValueError("the spec needs loader.id_col")


def check_spec(spec: Mapping) -> None:
    """Stop at names that mean nothing here: a misspelt setting would otherwise be ignored."""
    strange = [s for s in spec if s not in KNOWN_KEYS]
    strange += [f"{s}.{k}" for s in spec if s in KNOWN_KEYS for k in section(spec, s) if k not in KNOWN_KEYS[s]]
    if strange:
        raise ValueError(f"unknown settings in the spec: {strange}")
    unknown = [m for m in spec["models"]["active"] if m not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown models in the spec: {unknown}")


def loader_of(spec: Mapping) -> Loader:
    """The id stays in the table whether or not it is listed to be dropped; it is never a feature."""
    part = spec["loader"]
    return Loader(
        target=part["target_col"], path=part.get("train_path", ""), format=part.get("format", "csv"),
        schema=part.get("schema"), drop_cols=tuple(c for c in part.get("drop_cols") or () if c != id_of(spec)),
        drop_missing_thresh=part.get("drop_missing_thresh"), promote=part.get("promote_numeric", False),
        multi_line=part.get("multi_line", False),
    )


def variants_of(spec: Mapping) -> list[tuple[str, str, Variant]]:
    """(key, base model, variant) of everything to train, reduced variants after plain ones."""
    winsor, flat, reduced = (set(section(spec, s).get("apply_to") or ()) for s in ("outliers", "multicollinearity", "pca"))
    fe = section(spec, "feature_engineering")
    dropped = {m: list(names) for m, names in (fe.get("drop_cols_for") or {}).items()}
    for m in (fe.get("drop_raw_fare_for") or ()) if fe.get("enabled") else ():
        dropped.setdefault(m, []).append("Fare")
    out = []
    for name in spec["models"]["active"]:
        plain = Variant(name in winsor, name in flat, tuple(dropped.get(name, ())))
        out.append((name, name, plain))
        if name in reduced:
            out.append((f"{name}_pca", name, Variant(plain.winsor, plain.decollinear, plain.drop_cols, True)))
    return out


@dataclass
class Steps:
    """Fits of the preparation steps beyond the cleaned rows. Each is run once, by the first that asks for it; threads may ask side by side."""

    spec: Mapping
    prepared: Prepared
    cleaned: DataFrame
    meta: list[str]
    locks: dict = field(default_factory=lambda: {s: Lock() for s in ("outliers", "collinear", "encoders", "reducers")})
    done: set = field(default_factory=set)

    def outliers(self) -> OutlierModel | None:
        with self.locks["outliers"]:
            if "outliers" not in self.done and section(self.spec, "outliers"):
                o = self.spec["outliers"]
                self.prepared.outliers = Outliers(
                    o.get("detection", "iqr"), o.get("treatment", "winsorization"), o.get("iqr_threshold", 1.5),
                    o.get("zscore_threshold", 3.0), tuple(o.get("cols") or numeric_columns(self.cleaned, self.meta)),
                ).fit(self.cleaned)
            self.done.add("outliers")
            return self.prepared.outliers

    def collinear(self) -> CollinearModel | None:
        outliers = self.outliers()
        with self.locks["collinear"]:
            if "collinear" not in self.done and section(self.spec, "multicollinearity"):
                m = self.spec["multicollinearity"]
                both = any(v.winsor and v.decollinear for _, _, v in variants_of(self.spec)) and outliers is not None
                seen = outliers.transform(self.cleaned) if both else self.cleaned
                nums = numeric_columns(self.cleaned, self.meta)
                self.prepared.collinear = Collinear(m.get("threshold", 0.85), m.get("drop", True), nums).fit(seen)
            self.done.add("collinear")
            return self.prepared.collinear

    def encoder(self, winsor: bool, flat: bool) -> EncoderModel:
        """That of variants without collinear columns, or of all others."""
        df, e = self.cleaned, section(self.spec, "encoder")
        if flat:
            collinear, outliers = self.collinear(), self.prepared.outliers
            df = outliers.transform(df) if winsor and outliers else df
            df = collinear.transform(df) if collinear else df
        with self.locks.setdefault((winsor, flat), Lock()):
            if (winsor, flat) not in self.prepared.encoders:
                encoder = Encoder(e.get("num_strategy", "standard"), e.get("cat_strategy", "ohe"))
                self.prepared.encoders[(winsor, flat)] = encoder.fit(df, self.meta)
            return self.prepared.encoders[(winsor, flat)]

    def ready(self, v: Variant) -> None:
        """All that a variant's rows take."""
        if v.winsor:
            self.outliers()
        self.encoder(v.winsor and v.decollinear, v.decollinear)
        if v.pca:
            with self.locks["reducers"]:
                if v not in self.prepared.reducers:
                    plain = Variant(v.winsor, v.decollinear, v.drop_cols)
                    wide = self.prepared.matrix(self.cleaned, plain, self.meta)
                    names = [c for c in wide.columns if c not in self.meta]
                    self.prepared.reducers[v] = Reducer(section(self.spec, "pca").get("n_components", 0.95)).fit(wide, names)

    def all(self) -> None:
        self.collinear()
        self.encoder(False, False)
        for _, _, v in variants_of(self.spec):
            self.ready(v)


def prepare(spec: Mapping, raw: DataFrame) -> tuple[Prepared, DataFrame, DataFrame]:
    """Fit the preparation steps; also returns the cleaned training frame with label and fold.

    Every later fit reads the cleaned rows, so they are persisted; the last value is the
    frame the caller has to unpersist.
    """
    steps, cached = begin(spec, raw)
    steps.all()
    return steps.prepared, steps.cleaned, cached


def begin(spec: Mapping, raw: DataFrame) -> tuple[Steps, DataFrame]:
    """The cleaned training frame with label and fold, and the steps still to be fitted on it; the caller has to unpersist the last value."""
    check_spec(spec)
    loader, id_col = loader_of(spec), id_of(spec)
    target = loader.target
    table = loader.prepare(raw)
    keep = [id_col, target]

    fe = section(spec, "feature_engineering")
    features = None
    if fe.get("enabled"):
        preset = fe.get("preset", "passenger")
        features = (FEATURE_PRESETS[preset]() if isinstance(preset, str) else preset).fit(table)
    derived = table if features is None else features.transform(table)

    cl = section(spec, "cleaner")
    imputer = Imputer(
        cl.get("num_strategy", "median"), cl.get("cat_strategy", "unknown"), cl.get("knn_neighbors", 5)
    ).fit(derived, exclude=keep, id_col=id_col)
    labels = LabelEncoder.fit(table, target)
    models = spec["models"]
    cleaned = labels.encode(imputer.transform(derived), target, LABEL)
    cleaned = cleaned.persist(StorageLevel.MEMORY_AND_DISK)
    shuffled = models.get("shuffle_folds", False)
    cleaned_folds = add_folds(
        cleaned, LABEL, id_col, models.get("cv", 5), FOLD, shuffle=shuffled, seed=models.get("random_state", 42)
    )
    prepared = Prepared(loader, id_col, features, imputer, None, None, {}, labels)
    return Steps(spec, prepared, cleaned_folds, [*keep, LABEL, FOLD]), cleaned


@dataclass
class FittedWorkflow:
    spec: Mapping
    prepared: Prepared
    entries: dict[str, Entry]
    vote: Vote | None

    def leaderboard(self, spark) -> DataFrame:
        """All models by score: mean of folds for models, pooled out of fold for the vote."""
        rows = [
            (i, e.key, e.base, e.variant.label, float(e.model.best_score), e.oof_score)
            for i, e in enumerate(self.entries.values())
        ]
        if self.vote is not None:
            label = f"ensemble({', '.join(self.vote.members)})"
            rows.append((len(rows), "ensemble", "ensemble", label, self.vote.score, self.vote.score))
        frame = spark.createDataFrame(
            rows, "seq int, model string, base string, dataset string, score double, oof_score double"
        )
        return ev.leaderboard(frame)

    def best_entries(self) -> dict[str, Entry]:
        """Best variant per base model; a later one must be strictly better."""
        best: dict[str, Entry] = {}
        for e in self.entries.values():
            if e.base not in best or e.model.best_score > best[e.base].model.best_score:
                best[e.base] = e
        return best

    def score(self, raw: DataFrame, key: str, output: str | None = None) -> DataFrame:
        """id and decoded prediction of one model, or of ``ensemble``, for a new table."""
        cleaned = self.prepared.clean(self._prepare_new(raw))
        return self._score_cleaned(cleaned, key, output or self.prepared.loader.target)

    def _prepare_new(self, raw: DataFrame) -> DataFrame:
        from ..functions.columns import normalise_markers
        from ..functions.kinds import nan_to_null

        loader, id_col = self.prepared.loader, self.prepared.id_col
        extra = [c for c in loader.drop_cols if c != id_col]
        return normalise_markers(nan_to_null(raw)).drop(*extra, loader.target)

    def _scored(self, cleaned: DataFrame, entry: Entry, prefix: str = "") -> DataFrame:
        vectors = self.prepared.vectors(cleaned, entry.variant, [self.prepared.id_col])
        return entry.model.score(vectors, prefix).drop("features")

    def _score_cleaned(self, cleaned: DataFrame, key: str, output: str) -> DataFrame:
        id_col = self.prepared.id_col
        if key != "ensemble":
            scored = self._scored(cleaned, self.entries[key]).withColumnRenamed("prediction", "__code")
        else:
            members = [(self.entries[m].variant, self.entries[m].model, f"{m}_") for m in self.vote.members]
            scored = score_side_by_side(self.prepared, cleaned, members, [id_col])
            scored = scored.withColumn("__code", self._decide())
        return self.prepared.labels.decode(scored, "__code", output).select(col(id_col), col(output))

    def _decide(self):
        soft = self.vote.voting == "soft"
        kind = "probability" if soft else "prediction"
        weights = {f"{m}_{kind}": w for m, w in self.vote.members.items()}
        return soft_vote(weights, self.vote.threshold) if soft else hard_vote(weights)

    def write_predictions(self, raw: DataFrame, folder: str | None = None) -> list[str]:
        """One prediction file set per base model's best variant, and one for the vote."""
        folder = folder or self.spec["output"]["submission_dir"]
        cleaned = self.prepared.clean(self._prepare_new(raw)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            chosen = {base: e.key for base, e in self.best_entries().items()}
            if self.vote is not None:
                chosen["ensemble"] = "ensemble"
            target = self.prepared.loader.target
            return [
                write_predictions(
                    self._score_cleaned(cleaned, key, target), folder, base, self.prepared.id_col, target
                )
                for base, key in chosen.items()
            ]
        finally:
            cleaned.unpersist()


def score_side_by_side(
    prepared: Prepared, cleaned: DataFrame, members: list[tuple[Variant, TrainedModel | FoldCopies, str]], keep: list[str]
) -> DataFrame:
    """Score columns of several models. Each reads the same packed row, so nothing is joined."""
    df = cleaned.select(F.struct(*[col(c) for c in cleaned.columns]).alias("__row"))
    done: list[str] = []
    for variant, model, prefix in members:
        vectors = prepared.vectors(df.select("__row", *done, "__row.*"), variant, ["__row", *done])
        df = model.score(vectors, prefix).drop("features")
        done += [f"{prefix}probability", f"{prefix}prediction"]
    return df.select(*[F.col("__row")[k].alias(k) for k in keep], *[col(c) for c in done])


def side_by_side(spark, calls: Sequence[Callable], most: int) -> list:
    """The results of calls that run jobs of their own, in order; where one leaves cores idle, the others' tasks take them."""
    def here(call: Callable):
        spark.createDataFrame([], "n int")  # makes the session the thread's active one
        return call()

    # the target made for a session copies the thread properties once, so each call gets one of its own
    with ThreadPool(max(1, min(most, len(calls)))) as pool:
        return list(pool.imap(lambda call: call(), [inheritable_thread_target(spark)(partial(here, call)) for call in calls]))


def fit_workflow(spec: Mapping, raw: DataFrame, reports: bool = False) -> FittedWorkflow:
    """Prepare, search every active model and its variants, then form the vote."""
    steps, cached = begin(spec, raw)
    prepared, cleaned = steps.prepared, steps.cleaned
    models, cache = spec["models"], section(spec, "model_cache")
    scoring, seed, parallelism = models.get("scoring", "f1_weighted"), models.get("random_state", 42), models.get("parallelism", 8)
    meta = [prepared.id_col, LABEL, FOLD]
    digest = store.config_hash(spec, spec["loader"].get("train_path"), raw) if cache.get("enabled") else ""
    entries: dict[str, Entry] = {}
    rows: dict[Variant, SharedRows] = {}
    lock = Lock()
    copies: dict[str, list[TrainedModel]] = {}
    ens = section(spec, "ensemble")
    wanted = list(ens.get("members", models["active"])) if ens.get("enabled") else []
    try:
        def trained(key: str, base: str, variant: Variant) -> tuple[Entry, list[TrainedModel] | None]:
            steps.ready(variant)  # while the others already search
            with lock:
                if variant not in rows:
                    rows[variant] = SharedRows(prepared.vectors(cleaned, variant, meta))
            data = rows[variant].df  # the search caches what it rereads

            def build():
                model = train(base, data, scoring, seed, models.get("grids", {}).get(base, models.get("grid")), parallelism, rows[variant])
                if models.get("tune_threshold"):
                    model, _ = model.tune_threshold(data, models.get("threshold_scoring", "f1"), reuse=True)
                return model

            if cache.get("enabled"):
                model, _ = store.load_or_train(cache["path"], key, digest, build)
            else:
                model = build()
            own = model.fold_copies(data, reuse=True) if key in wanted else None
            oof = ev.score_value(model.out_of_fold(data, reuse=True), scoring) if reports else None
            return Entry(key, base, variant, model, oof), own

        for entry, own in side_by_side(cleaned.sparkSession, [partial(trained, *v) for v in variants_of(spec)], parallelism):
            entries[entry.key] = entry
            if own is not None:
                copies[entry.key] = own
        steps.all()
        vote = _form_vote(ens, wanted, entries, copies, prepared, cleaned, scoring) if wanted else None
    finally:
        for r in rows.values():
            r.release()
        cached.unpersist()
    return FittedWorkflow(spec, prepared, entries, vote)


def _form_vote(ens, wanted, entries, copies, prepared, cleaned, scoring) -> Vote | None:
    scores = {k: float(e.model.best_score) for k, e in entries.items()}
    weights, skipped = member_weights(wanted, scores, ens.get("weights", "auto"))
    if len(weights) < 2:
        return None
    voting = ens.get("voting", "soft")
    kind = "probability" if voting == "soft" else "prediction"
    members = [(entries[m].variant, FoldCopies(tuple(copies[m]), f"__row.{FOLD}"), f"{m}_") for m in weights]
    held_out = score_side_by_side(prepared, cleaned, members, [LABEL])
    mean = weighted_mean({f"{m}_{kind}": w for m, w in weights.items()})
    decided = held_out.withColumn("vote", (mean >= F.lit(0.5)).cast("double"))
    return Vote(weights, voting, ev.score_value(decided, scoring, LABEL, "vote"), skipped)
