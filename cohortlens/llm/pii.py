"""Personal data by candidate gradient boosting. DataFrame functions only.

1. High-recall generators (patterns) propose spans per kind. The four base kinds have exact rules
   (octets, Luhn, digit counts); what passes them is always selected.
2. All other proposals (local phone numbers, spelled-out addresses, national and account numbers,
   version-6 addresses, card-like numbers that fail Luhn) get format and context features, and
   boosted trees score them. The trees are turned into one column expression.
3. A proposal is selected if its score reaches its kind's threshold, which is calibrated on held-out
   rows for a wanted precision, and if it overlaps no base span and no better proposal.

The trees are fitted on ``TRAIN_ROWS`` labelled rows that Spark makes from the templates below (there
are no labelled spans in the corpus), half of them for fitting and half for calibration. That
number is the bound of the sample; candidate search, features and selection cover every whole text.

Defined results: a null or empty text has no spans and stays as it is; offsets are code points, end
exclusive; ties go to the leftmost span, then by kind order; repeated rows are treated one by one;
an empty table gives no rows; the span column replaces one of the same name, others are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Base kinds in their listed order, then the kinds that only the trees select.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "iban")
TRAIN_ROWS, PRECISION = 6000, 0.97
CONTEXT = 32  # characters of context on either side

#: Base patterns, in forms that the regex engine matches in linear time without recursion: a run is entered
#: at its start only (or where the last match ended) and its quantifiers are possessive. Same matches as the plain forms.
PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
#: Generators of further candidates: (kind, pattern, what a text needs for the pattern to be tried).
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,63}+){1,8}+", r"[\[(](?:at|AT)[\])]"),
    # Version 6: eight groups, or :: for some of them, with seven groups at most.
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
           r"|(?<![0-9A-Za-z:])(?!(?:[0-9A-Fa-f]{0,4}:){8}[0-9A-Fa-f])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+)?+::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+)?+(?<=[0-9A-Fa-f]:{0,2})(?![0-9A-Za-z:])",
     r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:|[0-9A-Fa-f]::|::[0-9A-Fa-f]"),
    ("card", PATTERN["card"], r"[0-9](?:[\x20-]?[0-9]){11}"),
    # National forms: 3-3-4, or a trunk 0 and 9 to 11 digits in all, in groups.
    ("phone", r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])"
              r"|(?<![0-9A-Za-z+.-])(?=\(?0(?:[)\x20./-]{0,2}[0-9]){8,10}(?![0-9A-Za-z-]))(?:\(0[0-9]{1,4}\)[\x20/-]?|0[0-9]{1,4}[\x20./-])[0-9]{2,8}(?:[\x20.-][0-9]{2,6}){0,3}(?![0-9A-Za-z-])",
     r"[0-9]{3}[\x20.-][0-9]{4}|0[0-9]{1,4}[)\x20./-]"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![0-9A-Za-z])", r"[A-Z]{2}[0-9]{2}"),
)
CUES = {
    "email": r"(?i)mail|contact|write|reach", "ip": r"(?i)\bip\b|host|server|address|login", "card": r"(?i)card|visa|credit|payment|amex",
    "phone": r"(?i)phone|tel\b|call|mobile|fax|contact", "ssn": r"(?i)ssn|social|security|tax", "iban": r"(?i)iban|account|bank|transfer",
}
#: Templates of the labelled rows: (kind, label, before, candidate, after); # is a digit, X a capital, x a hex digit.
TEMPLATES = (
    ("email", 1, "contact me: ", "jo.doe##[at]example.com", " thanks"), ("email", 1, "write to ", "info (at) mail#.example.org", "."),
    ("email", 1, "see ", "anna#[at]site[dot]net", " or"), ("email", 0, "matrix ", "a[at]b.c", "[i] = 0"), ("email", 0, "x = ", "v#[at]f.g", "(y)"),
    ("ip", 1, "host ", "20##:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx", " is"), ("ip", 1, "address ", "fe80:0:0:0:xxxx:xxxx:xxxx:xxxx", ","),
    ("ip", 1, "host ", "2001:db8::#", " is"), ("ip", 1, "server ", "20##:xxxx::xxxx:#", "."), ("ip", 1, "address ", "fe80::xxxx:xxxx:xxxx:xxxx", ","),
    ("ip", 1, "the ", "2###:xxxx:xxxx::#", " and"), ("ip", 1, "login from ", "::#", " at"), ("ip", 0, "call ", "a::b", "(c)"), ("ip", 0, "type ", "Bad::Cafe", " of"),
    ("ip", 0, "the ", "ace::add", "()"), ("ip", 0, "see ", "::dead", " x"), ("ip", 0, "hash ", "xx:xx:xx:xx:xx:xx:xx:xx", ":xx"), ("ip", 0, "ratio ", "#:#:#:#:#:#:#:#", " of"),
    ("card", 1, "my card is ", "4### #### #### ####", " exp"), ("card", 1, "visa payment ", "5###-####-####-####", "."), ("card", 1, "credit card: ", "################", " cvv"),
    ("card", 0, "number ", "################", " of"), ("card", 0, "order ", "##############", ","), ("card", 0, "the ", "####################", " and"),
    ("card", 0, "id ", "#############", " in"), ("card", 0, "codes ", "## ## ## ## ## ## ##", " x"), ("card", 0, "", "2###-##-## ##-##-##", " log"),
    ("phone", 1, "call ", "(###) ###-####", " now"), ("phone", 1, "phone: ", "###-###-####", "."), ("phone", 1, "tel ", "###.###.####", ","),
    ("phone", 1, "the ", "(###) ###-####", " and"), ("phone", 1, "of ", "###-###-####", " or"), ("phone", 1, "tel ", "020 #### ####", "."), ("phone", 1, "call ", "0# ## ## ## ##", " now"),
    ("phone", 1, "phone: ", "0###-#######", ","), ("phone", 1, "mobile ", "0#### ######", " or"), ("phone", 1, "fax ", "(0##) ########", "."), ("phone", 1, "the ", "0###/#######", " and"),
    ("phone", 0, "on ", "0#.##.#### 1#", ":##"), ("phone", 0, "part ", "0##.###.###", ".#"), ("phone", 0, "rows ", "0# ## ## ## ##", " ## ##"),
    ("phone", 0, "sum ", "### ### ####", " ### units"),
    ("phone", 0, "pages 1## ", "### ### ####", " 2##"), ("phone", 0, "part ", "###.###.####", ".#"),
    ("ssn", 1, "ssn ", "###-##-####", "."), ("ssn", 1, "social security ", "###-##-####", " of"), ("ssn", 0, "part ", "###-##-####", "/##"),
    ("ssn", 0, "isbn ## ", "###-##-####", " ##"), ("iban", 1, "iban ", "XX## #### #### #### ####", "."), ("iban", 1, "bank account ", "XX####################", " at"),
    ("iban", 0, "model ", "XX##XXXXXXXXXXXX", " in"), ("iban", 0, "key ", "XX##X#X#XX##X#X#", " ok"),
)
FEATURES = ("kind", "n_digits", "length", "n_other", "luhn", "n_letters", "cue", "digit_near", "touches", "n_distinct", "brackets")
HIT = "array<struct<start:int,end:int,s:string>>"


def hits(text: Column, pattern: str) -> Column:
    """All matches as (start, end, s), from the lengths of the matches and of the pieces between them."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(between, found, lambda a, b: F.struct(F.char_length(a).alias("gap"), b.alias("s")))
    none = F.struct(F.lit(0).alias("pos"), F.array().cast(HIT).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        end = start + F.coalesce(F.char_length(x["s"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["s"].alias("s")))
        return F.struct(end.alias("pos"), F.when(x["s"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], one)).alias("out"))

    return F.aggregate(steps, none, step, lambda acc: acc["out"])


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """Whether the digits of ``s`` have a Luhn sum that ends in 0."""
    def value(d: Column, i: Column) -> Column:
        v = d.cast("int")
        return F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v)
    ds = F.reverse(F.regexp_extract_all(digits(s), F.lit("[0-9]"), F.lit(0)))
    return F.aggregate(F.transform(ds, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def base_ok(kind: str, s: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return s.rlike(OCTETS)
    n = F.length(digits(s))
    return n.between(12, 19) & luhn(s) if kind == "card" else n.between(9, 15)


def _valid(kind: str):
    return lambda x: base_ok(kind, x["s"])


def _proposal(k: int):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"), x["s"].alias("s"))


def guarded(text: Column, test: Column, pattern: str) -> Column:
    """Matches, searched only in texts that pass a cheap necessary test."""
    return F.when(test, hits(text, pattern)).otherwise(F.array().cast(HIT))


NEEDS = {"email": lambda t: t.contains("@"), "phone": lambda t: t.contains("+"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
         "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")}


def features(kind: Column, s: Column, before: Column, after: Column) -> Column:
    """The struct of FEATURES (doubles) of a candidate."""
    cue = reduce(lambda c, k: c.when(kind == KINDS.index(k), before.rlike(CUES[k])), KINDS[1:], F.when(kind == 0, before.rlike(CUES[KINDS[0]])))
    ds, letters = digits(s), F.regexp_replace(s, "[^A-Za-z]", "")
    values = {
        "kind": kind, "n_digits": F.length(ds), "length": F.length(s), "n_other": F.length(s) - F.length(ds) - F.length(letters),
        "luhn": luhn(s), "n_letters": F.length(letters), "cue": cue,
        "digit_near": F.right(before, F.lit(4)).rlike("[0-9]") | F.left(after, F.lit(4)).rlike("[0-9]"),
        "touches": F.right(before, F.lit(1)).rlike("[A-Za-z0-9/#=]") | F.left(after, F.lit(1)).rlike(r"[A-Za-z0-9/#=\[(]"),
        "n_distinct": F.size(F.array_distinct(F.regexp_extract_all(s, F.lit("[0-9]"), F.lit(0)))), "brackets": s.rlike(r"[\[(]"),
    }
    return F.struct(*[F.coalesce(values[f].cast("double"), F.lit(0.0)).alias(f) for f in FEATURES])


def training_rows(spark: SparkSession, n: int = TRAIN_ROWS, templates=TEMPLATES) -> DataFrame:
    """(id, kind, label, FEATURES...) of ``n`` labelled candidates made from templates."""
    one = F.array(*[F.struct(F.lit(KINDS.index(k)).alias("kind"), F.lit(y).alias("label"), F.lit(b).alias("b"), F.lit(c).alias("c"), F.lit(a).alias("a"))
                    for k, y, b, c, a in templates])
    rows = spark.range(n).select("id", F.element_at(one, (F.col("id") % len(templates) + 1).cast("int")).alias("t"))

    def filled(c: Column, salt: int) -> Column:
        def char(ch: Column, i: Column) -> Column:
            draw = lambda values: F.substring(F.lit(values), (F.pmod(F.xxhash64("id", i, F.lit(salt)), F.lit(len(values))) + 1).cast("int"), F.lit(1))
            return F.when(ch == "#", draw("0123456789")).when(ch == "X", draw("ABCDEFGHKLMNPRSTUVW")).when(ch == "x", draw("0123456789abcdef")).otherwise(ch)
        return F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0)), char), "")

    rows = rows.select("id", "t.kind", "t.label", filled(F.col("t.c"), 1).alias("s"), filled(F.col("t.b"), 2).alias("b"), filled(F.col("t.a"), 3).alias("a"))
    return rows.select("id", "kind", F.col("label").cast("double").alias("label"), features(F.col("kind"), F.col("s"), F.col("b"), F.col("a")).alias("f")).select("id", "label", "f.*")


def _tree(node, feature) -> Column:
    """A fitted tree as a column expression."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(float(node.prediction()))
    split = node.split()
    return F.when(feature(FEATURES[split.featureIndex()]) <= float(split.threshold()), _tree(node.leftChild(), feature)).otherwise(_tree(node.rightChild(), feature))


class Model:
    """Boosted trees as an expression, and a threshold for each kind."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[int, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, feature) -> Column:
        return reduce(lambda a, b: a + b, [F.lit(w) * _tree(t, feature) for t, w in zip(self.trees, self.weights, strict=True)])

    def threshold(self, kind: Column) -> Column:
        return F.element_at(F.array(*[F.lit(self.thresholds.get(k, 1e9)) for k in range(len(KINDS))]), (kind + 1).cast("int"))


def fit(spark: SparkSession, n: int = TRAIN_ROWS, precision: float = PRECISION, rounds: int = 8, depth: int = 4, templates=TEMPLATES) -> Model:
    """Boosted trees on half of the labelled rows; the thresholds from the other half: for each kind the lowest
    score down to which the selected rows have the wanted precision (none: the kind is never added)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = training_rows(spark, n, templates)
    half = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows.where(half)).select("features", "label").coalesce(1).cache()
    fitted = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=7).fit(vectors)
    vectors.unpersist()
    model = Model([t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode") for t in fitted.trees], list(fitted.treeWeights), {})
    scored = rows.where(~half).select("kind", "label", model.score(F.col).alias("score"))
    down = Window.partitionBy("kind").orderBy(F.col("score").desc())
    reached = scored.withColumn("p", F.avg("label").over(down)).where(F.col("p") >= precision).groupBy("kind").agg(F.min("score").alias("least"))
    model.thresholds = {int(r["kind"]): float(r["least"]) for r in reached.collect()}  # a row for each kind
    return model


def held_out(spark: SparkSession, n: int = TRAIN_ROWS, folds: int = 4) -> DataFrame:
    """(kind, n_personal, n_other, precision, recall) on rows of templates that the model was neither fitted nor calibrated on:
    each fold of the templates is judged by a model of the others."""
    judged = None
    for f in range(folds):
        model = fit(spark, n, templates=[t for i, t in enumerate(TEMPLATES) if i % folds != f])
        rows = training_rows(spark, n // folds, [t for i, t in enumerate(TEMPLATES) if i % folds == f])
        own = rows.select("kind", "label", (model.score(F.col) >= model.threshold(F.col("kind"))).alias("chosen"))
        judged = own if judged is None else judged.unionByName(own)
    both, chosen, personal = F.count_if(F.col("chosen") & (F.col("label") == 1)), F.count_if(F.col("chosen")), F.count_if(F.col("label") == 1)
    name = F.element_at(F.array(*[F.lit(x) for x in KINDS]), (F.col("kind") + 1).cast("int"))
    return judged.groupBy(name.alias("kind")).agg(personal.alias("n_personal"), (F.count(F.lit(1)) - personal).alias("n_other"),
                                                  (both / F.nullif(chosen, F.lit(0))).alias("precision"), (both / F.nullif(personal, F.lit(0))).alias("recall"))


def find(df: DataFrame, model: Model, text: str = "text", to: str = "pii") -> DataFrame:
    """``df`` with array column ``to`` of (start, k, end, base): all selected spans by start, then kind (k: its place in KINDS).

    No shuffle: proposals, features, trees and selection are expressions over each row's arrays."""
    t = "__pii_text"
    out = df.drop(to).withColumn(t, F.coalesce(F.col(text), F.lit("")))
    c = F.col(t)
    for kind in BASE:
        out = out.withColumn(f"__base_{kind}", F.filter(guarded(c, NEEDS[kind](c), PATTERN[kind]), _valid(kind)))
    span = lambda k, is_base: lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("k"), x["end"].alias("end"), F.lit(is_base).alias("base"))
    base = F.concat(*[F.transform(F.col(f"__base_{kind}"), span(k, True)) for k, kind in enumerate(BASE)])
    out = out.withColumn("__base", base)
    proposed = []
    for i, (kind, pattern, needs) in enumerate(GENERATORS):
        out = out.withColumn(f"__more_{i}", guarded(c, c.rlike(needs), pattern))
        proposed.append(F.transform(F.col(f"__more_{i}"), _proposal(KINDS.index(kind))))
    free = F.filter(F.concat(*proposed), lambda x: ~F.exists(F.col("__base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    out = out.withColumn("__free", free)
    around = lambda x: F.struct(*[x[n].alias(n) for n in ("start", "k", "end")], features(
        x["k"], x["s"], F.substring(c, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT))),
        F.substring(c, x["end"] + 1, F.lit(CONTEXT))).alias("f"))
    out = out.withColumn("__with_features", F.when(F.size("__free") > 0, F.transform(F.col("__free"), around)))
    scored = F.transform(F.col("__with_features"), lambda x: F.struct(*[x[n].alias(n) for n in ("start", "k", "end")], model.score(lambda f: x["f"][f]).alias("score")))
    out = out.withColumn("__scored", F.filter(scored, lambda x: x["score"] >= model.threshold(x["k"])))
    better = lambda a, b: (a["score"] > b["score"]) | ((a["score"] == b["score"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["k"] < b["k"]))))
    chosen = F.filter(F.col("__scored"), lambda x: ~F.exists(F.col("__scored"), lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]) & better(y, x)))
    added = F.transform(F.coalesce(chosen, F.filter(F.col("__scored"), lambda x: F.lit(False))), lambda x: F.struct(x["start"], x["k"], x["end"], F.lit(False).alias("base")))
    out = out.withColumn(to, F.array_sort(F.when(F.col("__scored").isNull(), F.col("__base")).otherwise(F.concat(F.col("__base"), added))))
    return out.select(*[x for x in df.columns if x != to], to)


def as_string(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["k"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span, overlapping ones as one, replaced by its kind in brackets; as it is without spans."""
    mark = lambda k: F.element_at(F.array(*[F.lit(f"[{x.upper()}]") for x in KINDS]), k + 1)
    none = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        more = F.array(F.substring(text, acc["pos"] + 1, x["start"] - acc["pos"]), mark(x["k"]))
        return F.struct(F.greatest(acc["pos"], x["end"]).alias("pos"), F.when(x["start"] < acc["pos"], acc["out"]).otherwise(F.concat(acc["out"], more)).alias("out"))

    done = F.aggregate(spans, none, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.char_length(text) - acc["pos"])))
    return F.when(F.size(spans) > 0, done).otherwise(text)
