"""Personal data in texts: base patterns, and further candidates accepted by boosted trees.

Base spans: e-mail addresses, IPv4 addresses with numbers up to 255, card numbers of 16 to 19 digits whose checksum holds,
international phone numbers of 8 to 15 digits. High-recall generators propose more spans, which overlap each other and the base
ones: wide addresses, runs of digits with and without separators, dotted numbers, phone-like groups. Each candidate has
features of its format (lengths, digits, groups, marks, checksum, octets) and of its context (the character before and after).

The trees are trained on the documents at hand: a candidate is an example of its kind if a base span is exactly it, a
counter-example if not. All candidates of all documents are counted by their features (capped, so these have few values), and the
boosted trees are fitted to the counts of seven tenths of the texts. On the other texts, a threshold is set for each kind: the lowest
score from which on a share of at least ``precision`` of the candidates are base spans, at 95 % confidence (Wilson's
lower bound). Candidates that reach their kind's threshold and overlap no base span are added; of those that overlap each
other, the one with the higher score, then the longer one, then the first stays. Without examples of both sorts nothing is added.

All of it is native: patterns, features and the fitted trees are column expressions, evaluated where the text is.

Defined results: a very long text is handled whole, like any other (in one row); null and empty texts have no spans (and null stays null when redacted); rows with null or repeated ids are rows of
their own; an empty table gives no rows. Other columns are carried along by ``redact``, and not read by ``pii_spans``."""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import cut_lineage, written
from murmur.llm.spans import JOINT, apart, digits, joined, listing, luhn, matches, octets, of_kind

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = f"A-Za-z0-9._%+{JOINT}-", f"A-Za-z0-9{JOINT}-"
#: Runs are entered at their beginning or where the last match ended (\\G), never in their middle: the same matches, in linear time.
EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++{JOINT}[{_HOST}]+"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = f"[0-9][0-9{JOINT}]+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WIDE_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}.-]+"
DIGIT_RUN = r"(?<![0-9])[0-9]{13,19}(?![0-9])"
DIGIT_GROUPS = r"(?<![0-9])[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}(?![0-9])"
DOTTED = r"(?<![0-9])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])"
PHONE_LIKE = r"(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20.-]{1,2}\(?[0-9]{2,4}\)?){2,4}"
FEATURES = ("kind", "length", "n_digits", "n_dots", "n_gaps", "n_letters", "n_groups", "plus", "brackets", "at", "checksum", "octets", "before", "after")
MIN_EXAMPLES = 20


def base_spans(text: Column) -> Column:
    """(s, k, e) by kind, then start; k an index into KINDS."""
    has_card = text.rlike(r"[0-9][0-9\x20-]{14,}[0-9]")
    email = of_kind(matches(joined(text, ".", "A-Za-z0-9-", "A-Za-z0-9-"), EMAIL, text.contains("@")), 0)
    ip = of_kind(matches(text, IP, text.rlike(r"[0-9]\.[0-9]+\.[0-9]")), 1, octets)
    card = of_kind(matches(joined(text, r"\x20-", "0-9", "0-9"), CARD, has_card), 2,
                   lambda v: F.length(digits(v)).between(16, 19) & luhn(v))
    phone = of_kind(matches(text, PHONE, text.contains("+")), 3, lambda v: F.length(digits(v)).between(8, 15))
    return F.concat(email, ip, card, phone)


def candidates(text: Column, base: Column) -> Column:
    """Proposed spans with their features: (s, k, e, f array<double>), sorted, without repeats; the base spans are among them."""
    number = text.rlike(r"[0-9][0-9().\x20-]{6,}[0-9]")
    made = [(0, WIDE_EMAIL, text.contains("@")), (2, DIGIT_RUN, number), (2, DIGIT_GROUPS, number), (1, DOTTED, text.rlike(r"[0-9]\.[0-9]+\.[0-9]")),
            (3, PHONE_LIKE, number)]
    every = F.array_sort(F.array_distinct(F.concat(base, *[of_kind(matches(text, p, g), k) for k, p, g in made])))
    return F.transform(every, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), features(text, x).alias("f")))


def features(text: Column, x: Column) -> Column:
    v = F.substring(text, x["s"] + 1, x["e"] - x["s"])
    count = lambda pattern: F.least(F.regexp_count(v, F.lit(pattern)), F.lit(40))
    d = F.length(digits(v))
    one = lambda at: F.substring(text, at, F.lit(1))

    def sort_of(c: Column) -> Column:
        return (F.when(c.rlike("[0-9]"), 1).when(c.rlike(r"\p{L}"), 2).when(c.rlike("[.,;:!?]"), 3).when(c.rlike(r"\S"), 4).otherwise(0))

    before = F.when(x["s"] > 0, sort_of(one(x["s"]))).otherwise(0)
    out = [x["k"], F.least(x["e"] - x["s"], F.lit(60)), F.least(d, F.lit(25)), count("[.]"), count(r"[\x20-]"), count(r"\p{L}"), count("[0-9]+"),
           v.startswith("+").cast("int"), count("[()]"), count("@"),
           F.when(d.between(12, 25), luhn(v).cast("int")).otherwise(-1),
           F.when(v.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), octets(v).cast("int")).otherwise(-1), before, sort_of(one(x["e"] + 1))]
    return F.array(*[c.cast("double") for c in out])


def _tree(node, f: Column) -> Column:
    """A fitted tree as a column expression."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    return (F.when(f[int(split.featureIndex())] <= F.lit(float(split.threshold())), _tree(node.leftChild(), f))
            .otherwise(_tree(node.rightChild(), f)))


class Scorer:
    """Fitted trees and thresholds; adds spans to base ones."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[int, float]):
        self.trees, self.weights, self.thresholds = trees, weights, thresholds

    def score(self, f: Column) -> Column:
        total = F.lit(0.0)
        for t, w in zip(self.trees, self.weights):
            total = total + F.lit(float(w)) * _tree(t, f)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * total))

    def more(self, base: Column, found: Column) -> Column:
        """The candidates to add, as (s, k, e)."""
        none = F.array().cast("array<struct<s: int, k: int, e: int>>")
        if not self.thresholds:
            return none
        limit = lambda k: F.when(F.lit(False), 2.0) if not self.thresholds else F.coalesce(
            *[F.when(k == i, F.lit(float(t))) for i, t in self.thresholds.items()], F.lit(2.0))
        new = F.filter(found, lambda x: apart(x, base))
        new = F.transform(new, lambda x: F.struct((-self.score(x["f"])).alias("p"), (x["s"] - x["e"]).alias("n"), x["s"].alias("s"), x["k"].alias("k"),
                                                  x["e"].alias("e")))
        new = F.array_sort(F.filter(new, lambda x: -x["p"] >= limit(x["k"])))
        pick = F.aggregate(new, none, lambda acc, x: F.when(
            apart(x, acc), F.array_append(acc, F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))).otherwise(acc))
        return F.when(F.size(found) > F.size(base), pick).otherwise(none)


def _wilson(hits: float, n: float, z: float = 1.645) -> float:
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def train(found: DataFrame, precision: float = 0.98, trees: int = 10, depth: int = 4) -> Scorer:
    """Fit trees and thresholds to ``found``: k (a hash of the text), base, cands."""
    rows = found.where(F.size("cands") > 0).select((F.pmod("k", F.lit(10)) < 7).alias("learn"), F.col("base"), F.explode("cands").alias("c"))
    hit = F.exists("base", lambda b: (b["s"] == F.col("c.s")) & (b["e"] == F.col("c.e")) & (b["k"] == F.col("c.k")))
    counts = cut_lineage(rows.select("learn", F.col("c.f").alias("f"), hit.cast("int").alias("label")).groupBy("learn", "f", "label")
                         .agg(F.count("*").cast("double").alias("weight")))
    seen = {(r.learn, r.label): r.n for r in counts.groupBy("learn", "label").agg(F.sum("weight").alias("n")).collect()}
    if min((seen.get((a, b), 0) for a in (True, False) for b in (0, 1)), default=0) < MIN_EXAMPLES:
        return Scorer([], [], {})
    wide = counts.select("learn", "label", "weight", *[F.col("f")[i].alias(n) for i, n in enumerate(FEATURES)])
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(wide)
    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=64, stepSize=0.3, seed=7, weightCol="weight").fit(data.where("learn"))
    scorer = Scorer([t._java_obj.rootNode() for t in model.trees], list(model.treeWeights), {})
    held = counts.where(~F.col("learn")).select(F.col("f")[0].cast("int").alias("k"), F.round(scorer.score(F.col("f")), 3).alias("p"), "label", "weight")
    # at most 4 kinds, 1,001 scores and 2 labels
    table = held.groupBy("k", "p").agg(F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("label")).alias("hits")).orderBy(F.desc("p")).collect()
    for kind in range(len(KINDS)):
        n = hits = 0.0
        for r in table:
            if r.k == kind:
                n, hits = n + r.n, hits + r.hits
                if _wilson(hits, n) >= precision:
                    scorer.thresholds[kind] = max(0.5, r.p - 0.0005)
    return scorer


def find(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, k, base, cands) of each row's text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("t")).select("doc_id", F.xxhash64("t").alias("k"), "t", base_spans(F.col("t")).alias("base"))
    return rows.select("doc_id", "k", "base", candidates(F.col("t"), F.col("base")).alias("cands"))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (s, k, e) by kind and start; ``spans`` holds the base ones too."""
    found = cut_lineage(find(docs, id_col, text_col))
    scorer = train(found, **how)
    spans = F.array_sort(F.transform(F.concat("base", scorer.more(F.col("base"), F.col("cands"))),
                                     lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))))
    return found.select("doc_id", "base", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds and the listings of the spans."""
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        F.sha2(listing(F.col("base"), KINDS).cast("binary"), 256).alias("base_sha256"), listing(F.col("spans"), KINDS).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with [KIND] in place of each span; of spans that overlap, the first one's kind stands for all of them."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    in_order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        new = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.element_at(tags, x["k"] + 1)))
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], new).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(in_order, start, step)
    return F.when(F.size(spans) > 0, F.concat(F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the spans of ``text_col`` replaced by their kinds in brackets. Texts are searched once: rows are written with what was found
    in them, which the trees are trained on and the spans are taken from."""
    names = docs.columns
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), text.alias("_raw"), F.coalesce(text, F.lit("")).alias("t"))
    rows = rows.select("_row", "_raw", "t", F.xxhash64("t").alias("k"), base_spans(F.col("t")).alias("base"))
    found = written(rows.select("_row", "_raw", "k", "base", candidates(F.col("t"), F.col("base")).alias("cands")), "pii")
    spans = F.concat("base", train(found, **how).more(F.col("base"), F.col("cands")))
    return found.select(*[redacted(F.col("_raw"), spans).alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in names])
