"""Licence scan by a trained paragraph classifier (operator 9), native.

A paragraph is a line; a notice may also be wrapped over several (below). Its
word two- and three-grams are the features of a
multinomial logistic regression over licence families and ``none``. The model
is fitted on a small labelled table and a bounded sample of the corpus's own
ordinary paragraphs, with an L1 step, so it keeps few n-grams. Probabilities
are calibrated by a temperature and a threshold from the sample: a paragraph
with licence evidence under the threshold is ``unknown``. A family is
confirmed when a paragraph holds enough of one of the family's notices.

A paragraph has one likely family, and a hard-wrapped notice has too little of
itself in any line. So each notice is also sought by itself, in stretches of
as many lines as it may be wrapped over (``WRAP_WORDS`` words a line; blank
lines do not end a stretch): its family is confirmed as well where a stretch
holds enough of the notice, and of what no other family's notices say, and the
family's odds against ``none`` pass the threshold.

Scanning is DataFrame work alone: paragraphs and n-grams are exploded, joined
with the n-grams' weights (a table of the notices' n-grams, broadcast after a count), and
summed per paragraph. A paragraph without a kept n-gram is ``none`` by the
intercepts and needs no row.

Defined cases: null text has no paragraphs; empty lines are none; repeated
rows are reported each; ties between families go to the first in alphabetical
order; a document without licence has empty lists; an empty table gives an
empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import bounded, run_dir
from .common import located, stored
from .licence_rows import NOTICES, ORDINARY

SAMPLE_PARAGRAPHS = 1000
SAMPLE_CHARS = 4000  # longer paragraphs are not in the learned sample
CONFIRM = 0.5  # share of a notice's n-grams that a paragraph must hold
WRAP_WORDS = 4  # a wrapped notice has at least so many words a line
STEPS = 720_720  # places of a line, so that notices of different lengths share one window
NONE = "none"
# Between words; what a version or a licence name joins stays one word.
_BREAK = r"[^\p{L}\p{N}.+-]+|[.+-]+(?=[^\p{L}\p{N}.+-]|$)"
_BREAK_PY = re.compile(r"[^\w.+-]+|_+|[.+-]+(?=[^\w.+-]|_|$)")


def grams(paragraph: str) -> set[str]:
    """The distinct word two- and three-grams, as the scan makes them."""
    words = [w for w in _BREAK_PY.split(paragraph.lower()) if w]
    return {" ".join(words[i:i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}


def gram_column(paragraph: Column) -> Column:
    """The word two- and three-grams of a paragraph, repeats included."""
    def join(words: Column) -> Column:
        rest = lambda n: F.slice(words, n, F.size(words))
        two = F.zip_with(words, rest(2), lambda a, b: F.concat(a, F.lit(" "), b))  # null where there is no second
        three = F.zip_with(two, rest(3), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(two, three)
    words = F.filter(F.split(F.lower(paragraph), _BREAK), lambda w: w != "")
    # an array of one element binds the words once; as an expression they would be split again at each use
    return F.get(F.transform(F.array(words), join), F.lit(0))


class Model:
    """Families, intercepts, n-gram weights (few; the rest are zero), temperature and threshold."""

    def __init__(self, notices: list[tuple[str, str]], ordinary: list[str], rounds: int = 400, rate: float = 0.5,
                 l1: float = 2e-4, keep_false: float = 1e-3):
        self.notices = notices
        self.families = sorted({f for f, _ in notices}) + [NONE]
        rows = [(grams(t), self.families.index(f)) for f, t in notices] + [(grams(t), len(self.families) - 1) for t in ordinary]
        held = [(g, y) for k, (g, y) in enumerate(rows) if y == len(self.families) - 1 and k % 4 == 3]
        rows = [r for r in rows if not any(r is h for h in held)]
        names = sorted(set().union(*(g for g, y in rows if y < len(self.families) - 1)))
        at = {g: i for i, g in enumerate(names)}
        x = np.zeros((len(rows), len(names)))
        for r, (g, _) in enumerate(rows):
            x[r, [at[i] for i in g if i in at]] = 1
        y = np.eye(len(self.families))[[k for _, k in rows]]
        # families and the many ordinary rows weigh the same
        weigh = (1 / y.sum(axis=0))[y.argmax(axis=1)] * len(rows) / len(self.families)
        w, b = np.zeros((len(names), len(self.families))), np.zeros(len(self.families))
        for _ in range(rounds):
            p = self._softmax(x @ w + b)
            error = (p - y) * weigh[:, None] / len(rows)
            w -= rate * 20 * (x.T @ error)
            w = np.sign(w) * np.maximum(np.abs(w) - rate * l1, 0)  # the L1 step
            b -= rate * error.sum(axis=0)
        kept = np.flatnonzero(np.abs(w).max(axis=1) > 0)
        self.names, self.weights, self.intercepts = [names[i] for i in kept], w[kept], b
        self._calibrate(rows, held, keep_false)

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def logits(self, found: set[str]) -> np.ndarray:
        at = [i for i, g in enumerate(self.names) if g in found]
        return self.intercepts + self.weights[at].sum(axis=0)

    def _calibrate(self, rows: list, held: list, keep_false: float) -> None:
        """Temperature of least loss over labelled and held-out rows; the threshold is where
        ``keep_false`` of the ordinary rows would pass, a half at least."""
        z = np.array([self.logits(g) for g, _ in rows + held])
        y = np.array([k for _, k in rows + held])
        loss = {t: -np.log(self._softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in (0.5, 0.7, 1.0, 1.5, 2.0, 3.0)}
        self.temperature = min(loss, key=loss.get)
        ordinary = self._softmax(z[y == len(self.families) - 1] / self.temperature)[:, :-1].max(axis=1)
        self.threshold = max(0.5, float(np.quantile(ordinary, 1 - keep_false)) if len(ordinary) else 0.5)

    def table(self, spark: SparkSession) -> DataFrame:
        """(gram, w: weight per family), a few hundred rows."""
        return spark.createDataFrame([(g, [float(v) for v in w]) for g, w in zip(self.names, self.weights)],
                                     "gram string, w array<double>")


def learn(spark: SparkSession, docs: DataFrame, text_col: str = "text", notices: list[tuple[str, str]] = NOTICES,
          ordinary: list[str] = ORDINARY, sample_paragraphs: int = SAMPLE_PARAGRAPHS) -> Model:
    """A model from the notices and from the ``sample_paragraphs`` documents with the least hash,
    one paragraph of each (rows that hold a notice are left out as unlabelled)."""
    picked = (docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).where("length(text) > 0")
              .select(F.xxhash64("text").alias("h"), F.split("text", "\n").alias("p"))
              .select("h", F.element_at("p", (F.pmod("h", F.size("p")) + 1).cast("int")).alias("p"))
              .where(F.length("p") <= SAMPLE_CHARS).orderBy("h", "p").limit(sample_paragraphs))
    known = [grams(t) for _, t in notices]
    sample = [r.p for r in picked.select("p").distinct().collect()]
    sample = [p for p in sorted(sample) if not any(len(k & grams(p)) >= CONFIRM * len(k) for k in known)]
    return Model(notices, ordinary + sample)


def evidence(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """One row per line that has a kept n-gram: doc (all columns of ``docs`` but the text), line (from 0),
    grams and sum (weight per family)."""
    spark, k = docs.sparkSession, len(model.families)
    carried = [c for c in docs.columns if c != text_col]
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc"),
                        F.posexplode(F.split(F.col(f"`{text_col}`").cast("string"), "\n")).alias("line", "paragraph"))
    found = (keyed.select("doc", "line", F.explode(gram_column(F.col("paragraph"))).alias("gram"))
             .join(bounded(model.table(spark)), "gram"))
    return (found.groupBy("doc", "line").agg(F.collect_set(F.struct("gram", "w")).alias("found"))
            .select("doc", "line", F.transform("found", lambda x: x["gram"]).alias("grams"),
                    F.aggregate("found", F.array(*[F.lit(0.0)] * k),
                                lambda a, x: F.zip_with(a, x["w"], lambda u, v: u + v)).alias("sum")))


def paragraphs(sums: DataFrame, model: Model) -> DataFrame:
    """One row per line of ``evidence`` that the classifier does not call none: all columns of ``docs`` but the
    text, line, family (``unknown`` under the threshold), score, held (greatest share of a notice of the
    predicted family that the line holds) and confirmed."""
    k = len(model.families)
    z = [(F.get("sum", F.lit(i)) + F.lit(float(model.intercepts[i]))) / F.lit(float(model.temperature)) for i in range(k)]
    top = F.greatest(*z)
    scored = sums.select("doc", "line", "grams", F.array(*[F.exp(x - top) for x in z]).alias("e"))
    scored = scored.withColumn("total", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    best = F.array_max(F.slice("e", 1, k - 1))
    scored = scored.select(
        "doc", "line", "grams", (best / F.col("total")).alias("score"),
        F.element_at(F.array(*[F.lit(f) for f in model.families]),
                     F.array_position("e", best).cast("int")).alias("likely"),
        (F.element_at("e", k) / F.col("total")).alias("none"))
    # Template comparison: the notices of the likely family, as literal arrays of their kept n-grams.
    kept = set(model.names)
    share = F.lit(0.0)
    for family, notice in model.notices:
        own = sorted(grams(notice) & kept)
        if own:
            part = F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in own]))) / F.lit(float(len(own)))
            share = F.greatest(share, F.when(F.col("likely") == family, part).otherwise(0.0))
    sure = F.col("score") >= F.lit(float(model.threshold))
    return (scored.withColumn("held", share)
            .where(sure | (F.col("none") < 0.5))
            .select("doc.*", "line", F.when(sure, F.col("likely")).otherwise(F.lit("unknown")).alias("family"),
                    "score", "held", (sure & (F.col("held") >= CONFIRM)).alias("confirmed")))


def notice_table(model: Model) -> list[tuple]:
    """(gram, notice, family, lines, odds, n, own, n_own) per kept n-gram of each notice: the lines it may be wrapped
    over, the n-gram's log odds against none, the notice's n-grams, and those that no other family's notices have."""
    kept, rows = {g: i for i, g in enumerate(model.names)}, []
    for number, (family, notice) in enumerate(model.notices):
        held = sorted(grams(notice) & kept.keys())
        others = set().union(*(grams(t) for f, t in model.notices if f != family))
        at, n_own = model.families.index(family), len(set(held) - others)
        lines = max(2, -(-len(notice.split()) // WRAP_WORDS))
        rows += [(g, number, family, lines, float(model.weights[kept[g], at] - model.weights[kept[g], -1]), len(held),
                  int(g not in others), n_own) for g in held if n_own]
    return rows


def stretches(sums: DataFrame, model: Model) -> DataFrame:
    """One row per stretch of lines that holds enough of a notice: doc, line, last, family and score. Of
    stretches of a family that overlap, the one that holds most counts, then the first."""
    spark = sums.sparkSession
    notices = spark.createDataFrame(notice_table(model), "gram string, notice int, family string, lines int, odds double, "
                                    "n int, own int, n_own int")
    first = {f: float(model.intercepts[i] - model.intercepts[-1]) for i, f in enumerate(model.families)}
    base = F.create_map(*[F.lit(x) for pair in first.items() for x in pair])
    reach = max([lines for _, _, _, lines, *_ in notice_table(model)], default=2) - 1
    rows = sums.select("doc", "line", F.explode("grams").alias("gram")).join(bounded(notices), "gram")
    lines = (rows.groupBy("doc", "notice", "family", "lines", "n", "n_own", "line")
             .agg(F.collect_set(F.struct("gram", "odds", "own")).alias("held"))
             .withColumn("at", F.expr(f"line * {STEPS}L DIV lines")))
    # lines less than ``lines`` ahead are less than STEPS ahead; a line of as many or more is STEPS ahead at least
    ahead = Window.partitionBy("doc", "notice").orderBy("at").rangeBetween(0, STEPS - 1)
    found = (lines.withColumn("last", F.max("line").over(ahead))
             .withColumn("held", F.array_distinct(F.flatten(F.collect_list("held").over(ahead))))
             .withColumn("share", F.size("held") / F.col("n"))
             .withColumn("own", F.aggregate("held", F.lit(0), lambda a, x: a + x["own"]))
             .withColumn("odds", F.aggregate("held", base[F.col("family")],
                                             lambda a, x: a + x["odds"]))
             .withColumn("score", 1 / (1 + F.exp(-F.col("odds") / F.lit(float(model.temperature)))))
             .where((F.col("share") >= CONFIRM) & (F.col("own") >= CONFIRM * F.col("n_own"))
                    & (F.col("score") >= F.lit(float(model.threshold))))
             .groupBy("doc", "family", "line").agg(F.max(F.struct("share", (-F.col("last")).alias("back"), "score")).alias("best"))
             .select("doc", "family", "line", "best.share", (-F.col("best.back")).alias("last"), "best.score"))
    near = Window.partitionBy("doc", "family").orderBy("line")
    return (found.withColumn("before", F.max("share").over(near.rangeBetween(-reach, -1)))
            .withColumn("after", F.max("share").over(near.rangeBetween(1, reach)))
            .where((F.col("share") > F.coalesce("before", F.lit(0.0))) & (F.col("share") >= F.coalesce("after", F.lit(0.0))))
            .select("doc", "line", "last", "family", "score"))


def scan(spark: SparkSession, docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, families (confirmed, sorted), lines (``line:family`` of each
    confirmed paragraph, the first line of a wrapped one), n_confirmed, n_unconfirmed (lines of licence
    evidence that are not confirmed and in no confirmed stretch), score (the best)."""
    docs, file, row = located(docs)
    rows = docs.select(file.alias("file"), row.alias("row"), F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").alias("text"))
    lines = stored(evidence(rows.select("file", "row", "text"), model), f"{run_dir(spark, 'licences')}/evidence")
    marks = paragraphs(lines, model).select("file", "row", "line", F.col("line").alias("last"), "family", "score",
                                            "confirmed", F.lit(False).alias("stretch"))
    marks = marks.unionByName(stretches(lines, model).select("doc.*", "line", "last", "family", "score",
                                                             F.lit(True).alias("confirmed"), F.lit(True).alias("stretch")))
    one = F.struct("line", "family", "last", "score")
    sums = marks.groupBy("file", "row").agg(
        F.sort_array(F.collect_list(F.when(F.col("confirmed") & ~F.col("stretch"), one))).alias("sure"),
        F.sort_array(F.collect_list(F.when(F.col("stretch"), one))).alias("wide"),
        F.collect_list(F.when(~F.col("confirmed"), F.col("line"))).alias("open"),
        F.max(F.when(~F.col("stretch"), F.col("score"))).alias("score"))
    # a stretch around a confirmed line of its family is that paragraph, not another
    new = F.filter("wide", lambda x: ~F.exists("sure", lambda y: (y["family"] == x["family"]) & y["line"].between(x["line"], x["last"])))
    sums = sums.withColumn("new", new).select(
        "file", "row", F.sort_array(F.concat("sure", "new")).alias("marks"),
        F.size(F.filter("open", lambda x: ~F.exists("wide", lambda y: x.between(y["line"], y["last"])))).alias("n_unconfirmed"),
        F.greatest("score", F.array_max(F.transform("new", lambda x: x["score"]))).alias("score"))
    none = F.array().cast("array<string>")
    return (rows.select("file", "row", "id").join(sums, ["file", "row"], "left").select(
        "id", F.coalesce(F.array_sort(F.array_distinct(F.transform("marks", lambda m: m["family"]))), none).alias("families"),
        F.coalesce(F.transform("marks", lambda m: F.concat_ws(":", m["line"], m["family"])), none).alias("lines"),
        F.coalesce(F.size("marks"), F.lit(0)).cast("long").alias("n_confirmed"),
        F.coalesce("n_unconfirmed", F.lit(0)).cast("long").alias("n_unconfirmed"),
        F.coalesce("score", F.lit(0.0)).alias("score")))
