"""Personal data: generators propose spans, boosted trees score them, thresholds select.

Everything is DataFrame work: regular expressions mark matches, a window over a text's
matches turns lengths into positions, gradient-boosted trees of MLlib score candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import staged
from terrane.session import ensure_checkpoint_dir

KINDS = ["email", "ip", "card", "phone"]
MARK, NOT_MARK = "\u0001", "\u0002"

# (generator, kind, pattern). Base generators match leftmost without overlap; possessive
# quantifiers and look-behinds only spare the engine hopeless retries.
BASE = [
    (
        "email",
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    ("ip", "ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"),
    ("card", "card", r"[0-9](?:[\x20-]?+[0-9])++"),
    ("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]
# Spans the base ones miss because a neighbouring number ran into them, or by their form.
WIDE = [
    ("card tight", "card", r"(?<![0-9])(?:[0-9]{14,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])"),
    (
        "phone tight",
        "phone",
        r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20.-]?[0-9]{3,4}){2}(?![0-9])",
    ),
    (
        "phone local",
        "phone",
        r"(?<![0-9+.)-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])",
    ),
    (
        "email spelt",
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}+"
        r"(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]{1,63}+){1,8}+",
    ),
]

CUES = {  # words before a span that speak for a kind
    "email": "(?i)(mail|contact|write)",
    "ip": r"(?i)(\bip\b|host|server|address)",
    "card": "(?i)(card|visa|credit|pay|account)",
    "phone": "(?i)(phone|tel|call|mobile|fax)",
}
FEATURES = [
    "kind_no", "digits", "chars", "groups", "longest_group", "separators", "letters",
    "luhn", "greatest_part", "cue", "touches_before", "touches_after",
]


@dataclass(frozen=True)
class Training:
    """The trees are fitted on all base candidates but a quarter, drawn by hash, that is held
    out to calibrate the thresholds to `precision`."""

    trees: int = 10
    depth: int = 5
    precision: float = 0.95
    seed: int = 1


def _candidates_of(text: Column, generator: str, kind: str, pattern: str) -> Column:
    """An array with a struct a match: its place among the matches and what is around it.

    Matches are set between marks, so splitting gives gap, match, gap, match, ..., gap.
    """
    cheap = {"email": "[@\\[(]", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": "[0-9]"}[kind]
    marked = F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}")
    parts = F.split(marked, MARK, -1)

    def candidate(i: Column) -> Column:
        at = lambda k: F.get(parts_column, k)
        return F.struct(
            F.lit(generator).alias("generator"),
            F.lit(kind).alias("kind"),
            i.alias("place"),
            F.length(at(i - 1)).alias("gap"),
            at(i).alias("found"),
            F.right(at(i - 1), F.lit(24)).alias("before"),
            F.left(at(i + 1), F.lit(2)).alias("after"),
        )

    parts_column = F.col(f"parts {generator}")
    places = F.when(F.size(parts_column) > 1, F.sequence(F.lit(1), F.size(parts_column) - 2, F.lit(2)))
    return F.when(text.rlike(cheap), parts), F.transform(places, candidate)


def _luhn(digits: Column) -> Column:
    """Whether a string of 2 to 19 digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, k: Column) -> Column:
        digit = F.substring(F.reverse(digits), k, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(k % 2 == 0, twice).otherwise(digit)

    total = F.aggregate(places, F.lit(0), add)
    return F.when(F.length(digits).between(2, 19), total % 10 == 0).otherwise(F.lit(False))


def candidates(docs: DataFrame) -> DataFrame:
    """All candidates of all texts, with positions, features and the base verdict.

    One row a candidate and for texts without any one row whose `kind` is null: row_id,
    doc_id, text_key, generator, kind, start, end, base, valid and FEATURES. A written table.
    """
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), MARK, NOT_MARK)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("text_key"),
        text.alias("text"),
    )
    arrays = []
    for generator, kind, pattern in BASE + WIDE:
        parts, found = _candidates_of(F.col("text"), generator, kind, pattern)
        rows = rows.withColumn(f"parts {generator}", parts)
        arrays.append(F.coalesce(found, F.array().cast(_ARRAY)))
    keys = ["row_id", "doc_id", "text_key"]
    found = rows.select(*keys, F.explode_outer(F.concat(*arrays)).alias("c")).select(*keys, "c.*")
    found = staged(found, "pii-candidates")
    run = Window.partitionBy("row_id", "generator").orderBy("place")
    earlier = run.rowsBetween(Window.unboundedPreceding, -1)
    length = F.length("found")
    start = F.coalesce(F.sum(F.col("gap") + length).over(earlier), F.lit(0)) + F.col("gap")
    return _featured(found.withColumn("start", start).withColumn("end", F.col("start") + length))


_ARRAY = (
    "array<struct<generator:string,kind:string,place:int,gap:int,found:string,"
    "before:string,after:string>>"
)


def _featured(found: DataFrame) -> DataFrame:
    text = F.col("found")
    digits = F.regexp_replace(text, "[^0-9]", "")
    groups = F.filter(F.split(text, "[^0-9]+"), lambda g: g != "")
    parts = F.transform(groups, lambda g: F.when(F.length(F.ltrim(F.lit("0"), g)) > 3, 999).otherwise(g.cast("int")))
    cue = F.lit(False)
    for kind, words in CUES.items():
        cue = F.when(F.col("kind") == kind, F.col("before").rlike(words)).otherwise(cue)
    of = lambda kind: F.col("kind") == kind
    # A long run of digits is no candidate that needs numbers; it only has to be counted.
    short = F.length(text) <= 64
    features = {
        "kind_no": F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("double"),
        "digits": F.length(digits),
        "chars": F.length(text),
        "groups": F.when(short, F.size(groups)).otherwise(99),
        "longest_group": F.when(short, F.array_max(F.transform(groups, F.length))).otherwise(99),
        "separators": F.length(F.regexp_replace(text, r"[^\x20().-]", "")),
        "letters": F.length(F.regexp_replace(text, "[^A-Za-z]", "")),
        "luhn": F.when(of("card"), _luhn(F.when(short, digits))).otherwise(F.lit(False)),
        "greatest_part": F.when(of("ip"), F.array_max(parts)).otherwise(0),
        "cue": cue,
        "touches_before": F.col("before").rlike(r"[\w@.]\Z"),
        "touches_after": F.col("after").rlike(r"\A[\w@]"),
    }
    featured = found.withColumns(
        {name: F.coalesce(column.cast("double"), F.lit(0.0)) for name, column in features.items()}
    )
    valid = (
        F.when(of("email"), F.lit(True))
        .when(of("ip"), F.col("greatest_part") <= 255)
        .when(of("card"), F.col("digits").between(14, 19) & (F.col("luhn") == 1))
        .when(of("phone"), F.col("digits").between(10, 15))
    )
    base = F.col("generator").isin([generator for generator, _, _ in BASE])
    return staged(
        featured.withColumn("base", base).withColumn("valid", valid).drop("found", "before", "after", "gap", "place"),
        "pii-featured",
    )


def fit_trees(found: DataFrame, training: Training) -> tuple[Model, dict[str, float]] | None:
    """Boosted trees for "is personal data", and a threshold for each kind; None without
    candidates.

    Base candidates teach: those the checks of their kind confirm are examples, the others
    counterexamples. Trees see format and context, not the generator. Every candidate counts:
    those alike in features and label are one row with their number as its weight.
    """
    place = F.xxhash64(F.lit(training.seed), "text_key", "kind", "start")
    alike = [*FEATURES, "kind", "label", "held_out"]
    rows = found.filter("base").withColumn("label", F.col("valid").cast("double"))
    rows = rows.withColumn("held_out", F.pmod(place, F.lit(4)) == 0)
    rows = rows.groupBy(*alike).agg(F.count(F.lit(1)).cast("double").alias("weight")).orderBy(*alike)
    rows = staged(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).drop(*FEATURES), "pii-training")
    fitting = rows.filter("NOT held_out")
    if not fitting.take(1):
        return None
    ensure_checkpoint_dir(found.sparkSession)
    trees = GBTClassifier(maxIter=training.trees, maxDepth=training.depth, seed=training.seed, weightCol="weight")
    model = trees.fit(fitting)
    scored = model.transform(rows.filter("held_out")).withColumn("bin", _bin(_score()))
    right = F.sum(F.col("label") * F.col("weight"))
    bins = scored.groupBy("kind", "bin").agg(right.alias("right"), F.sum("weight").alias("all"))
    thresholds = {kind: 0.5 for kind in KINDS}
    for kind in KINDS:
        right = total = 0
        for _, bin_no, good, count in sorted(bins.filter(F.col("kind") == kind).collect(), key=lambda r: -r[1]):
            right, total = right + good, total + count
            if right < training.precision * total:
                thresholds[kind] = max(thresholds[kind], (bin_no + 1) / 50)
                break
    return model, thresholds


def _score() -> Column:
    return F.get(vector_to_array("probability"), F.lit(1))


def _bin(score: Column) -> Column:
    return F.floor(score * 50).cast("int")


def find_spans(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """Spans of all texts: row_id, doc_id, text_key, kind, start, end, base.

    Base spans that pass their checks always stay. Of the wider generators' candidates, those
    stay whose score reaches the threshold of their kind and that overlap neither a base span
    nor an added one before them. Texts without spans have one row whose kind is null. A
    table without candidates has none to learn from and only such rows.
    """
    found = candidates(docs)
    fitted = fit_trees(found, training)
    base = found.filter("base AND valid").withColumn("score", F.lit(1.0))
    if fitted is None:
        chosen = base.drop(*FEATURES)
    else:
        model, thresholds = fitted
        wide = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found.filter("NOT base"))
        scored = model.transform(wide).withColumn("score", _score())
        enough = F.lit(False)
        for kind, threshold in thresholds.items():
            enough = enough | ((F.col("kind") == kind) & (F.col("score") >= threshold))
        columns = [c for c in base.columns if c not in FEATURES]
        chosen = base.select(columns).unionByName(scored.filter(enough).select(columns))
    keys = ["row_id", "doc_id", "text_key"]
    line = Window.partitionBy("row_id").orderBy("start", F.desc("base"), F.desc("end"))
    reach = F.max(F.when(F.col("base"), F.col("end"))).over(line.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(F.col("base"), F.col("start"))).over(line.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(following, F.col("end")) >= F.col("end"))
    marked = chosen.select(*keys, "kind", "start", "end", "base", clear.alias("clear"))
    wide = _apart(marked.filter("NOT base AND clear"), keys)
    spans = marked.filter("base").drop("clear").unionByName(wide.withColumn("base", F.lit(False)))
    nothing = F.lit(None)
    every = found.select(
        *keys, nothing.cast("string").alias("kind"), nothing.cast("long").alias("start"),
        nothing.cast("long").alias("end"), F.lit(False).alias("base"),
    ).distinct()
    return spans.unionByName(every)


def _apart(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Of spans (start, end, kind) of a row those that overlap none that is kept before them.

    Runs of spans that overlap are told apart by a window; each run, which is short, is then
    walked from the left.
    """
    line = Window.partitionBy("row_id").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    begins = (F.col("start") >= F.coalesce(reach, F.lit(0))).cast("int")
    island = F.sum("begins").over(line.rowsBetween(Window.unboundedPreceding, 0))
    cut = spans.withColumn("begins", begins).withColumn("island", island)
    one = F.struct("start", (-F.col("end")).alias("back"), "kind")
    runs = cut.groupBy(*keys, "island").agg(F.array_sort(F.collect_list(one)).alias("run"))

    def step(state: Column, span: Column) -> Column:
        free = span["start"] >= state["at"]
        kept = F.when(free, F.concat(state["kept"], F.array(span))).otherwise(state["kept"])
        return F.struct(F.when(free, -span["back"]).otherwise(state["at"]).alias("at"), kept.alias("kept"))

    none = F.filter("run", lambda span: F.lit(False))
    zero = F.struct(F.lit(0).cast("long").alias("at"), none.alias("kept"))
    kept = F.explode(F.aggregate("run", zero, step, lambda state: state["kept"])).alias("span")
    return runs.select(*keys, kept).select(
        *keys, "span.kind", "span.start", (-F.col("span.back")).alias("end")
    )


def _listed(only_base: bool) -> Column:
    """Spans as kind:start:end in order, joined by commas."""
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    wanted = F.col("kind").isNotNull() & (F.col("base") if only_base else F.lit(True))
    span = F.when(wanted, F.struct(F.col("start"), number.alias("number"), F.col("end"), F.col("kind")))
    ordered = F.array_sort(F.collect_list(span))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """A row a document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256,
    spans (all of them, `kind:start:end` in code points).

    Null texts are empty ones. Repeated rows come out each; other columns are left out.
    """
    spans = find_spans(docs, training)
    counts = [F.count_if((F.col("kind") == kind) & F.col("base")).alias(f"n_{kind}") for kind in KINDS]
    rows = spans.groupBy("row_id", "doc_id").agg(
        *counts, _listed(True).alias("base_spans"), _listed(False).alias("spans")
    )
    names = [f"n_{kind}" for kind in KINDS]
    return rows.select("doc_id", *names, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def redact(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """The same rows and columns; in `text` every span is replaced by its kind in brackets.

    Overlapping spans are replaced as one, under the first one's kind. Null texts stay null.
    """
    spans = find_spans(docs.select("doc_id", "text"), training).filter("kind IS NOT NULL")
    span = F.struct("start", F.col("end"), "kind")
    lists = spans.groupBy("row_id", "text_key").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    lists = lists.groupBy("text_key").agg(F.first("spans").alias("_spans"))  # equal rows, equal spans
    lists = lists.withColumnRenamed("text_key", "_text_key")
    joined = docs.withColumn("_text_key", F.xxhash64("doc_id", "text")).join(lists, "_text_key", "left")
    text = F.col("text")

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        out = F.when(
            fresh,
            F.concat(
                state["out"],
                F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int")),
                F.lit("["),
                F.upper(s["kind"]),
                F.lit("]"),
            ),
        ).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    finish = lambda state: F.concat(
        state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text))
    )
    redacted = F.when(F.col("_spans").isNull(), text).otherwise(
        F.aggregate("_spans", zero, step, finish)
    )
    return joined.withColumn("text", redacted).select(docs.columns)
