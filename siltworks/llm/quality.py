"""Quality classifier by co-training on two views of a document.

The content view is hashed words and punctuation; the page view is source, language and
measures of the page's form (length, lines, shares of capitals, digits and signs, repetition).
Each view has a logistic regression. In every round each labels all unlabelled
documents, and those it is surest of, by class and in the share that the labels have, join
the training rows of the other view. In the end each view is calibrated on labelled rows that were held out
(Platt scaling) and the two are combined as independent evidence: log odds add up, less the
prior once.

Training reads at most LABELLED labelled documents, the first by a hash of the id. Every
exchange scores all unlabelled documents. One pass over the texts leaves numbers of hashed words
and the page view for all exchanges; scores are ranked in ranges, and the features of the surest
are looked up by their ids, by broadcast only where they are few. Scoring reads every document, in
one pass without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import cut, ordered_prefix, table, written

LABELLED = 20_000
ROUNDS = 3
#: Share of the unlabelled documents that each view labels for the other in a round.
CONFIDENT = 0.03
HELD_OUT = 5
#: Up to so many chosen ids (of tens of bytes) are looked up by broadcast, more by a shuffle.
LOOKED_UP = 200_000
#: Training rows of a task, and the fewest tasks: so few send their gradients without a shuffle.
FIT_ROWS = 20_000
FIT_TASKS = 4
#: What lies between words.
BLANKS = r"[\x20\x09-\x0D]+"
CONTENT_DIM = 1 << 15
SOURCE_DIM = 64


@dataclass(frozen=True)
class View:
    model: LogisticRegressionModel
    slope: float
    offset: float

    def log_odds(self, name: str) -> tuple[str, Column]:
        return f"z_{name}", vector_to_array(f"raw_{name}")[1] * self.slope + self.offset


def _measures(text: Column) -> dict[str, Column]:
    length = F.length(text).cast("double")
    share = lambda signs: F.regexp_count(text, F.lit(signs)) / (length + 1)
    words = F.array_remove(F.split(text, BLANKS, -1), "")
    count = F.size(words).cast("double")
    lines = F.size(F.split(text, "\n", -1)).cast("double")
    return {
        "m_length": F.log1p(length),
        "m_lines": F.log1p(lines),
        "m_line_length": F.log1p(length / lines),
        "m_word_length": length / (count + 1),
        "m_capitals": share(r"\p{Lu}"),
        "m_digits": share("[0-9]"),
        "m_signs": share(r"[^\p{L}\p{N}\s]"),
        "m_new_words": F.size(F.array_distinct(words)) / (count + 1),
    }


def counted(docs: DataFrame, text_col: str, source_col: str, lang_col: str, keep: list[Column]) -> DataFrame:
    """keep, `_tf` (how often the text has words of each hash) and the vector `page`. Nulls count as empty strings."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(
        *keep,
        F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[^\p{L}\s]+"), F.lit(0)).alias("_words"),
        F.array(F.concat(F.lit("s:"), F.coalesce(source_col, F.lit(""))), F.concat(F.lit("l:"), F.coalesce(lang_col, F.lit("")))).alias("_tags"),
        *[c.alias(n) for n, c in _measures(text).items()],
    )
    out = HashingTF(numFeatures=CONTENT_DIM, inputCol="_words", outputCol="_tf").transform(plain)
    out = HashingTF(numFeatures=SOURCE_DIM, inputCol="_tags", outputCol="_hot").transform(out)
    page = VectorAssembler(inputCols=["_hot", *_measures(text)], outputCol="page").transform(out)
    return page.drop("_words", "_tags", "_hot", *_measures(text))


def views_of(rows: DataFrame) -> DataFrame:
    """Rows of `counted` with the two feature vectors `content` and `page`."""
    return Normalizer(inputCol="_tf", outputCol="content").transform(rows).drop("_tf")


def features(docs: DataFrame, text_col: str, source_col: str, lang_col: str, keep: list[Column]) -> DataFrame:
    """keep, and the two feature vectors `content` and `page`."""
    return views_of(counted(docs, text_col, source_col, lang_col, keep))


def _fit(rows: DataFrame, view: str, label: str = "label", reg: float = 1e-4) -> LogisticRegressionModel:
    lr = LogisticRegression(featuresCol=view, labelCol=label, rawPredictionCol=f"raw_{view}", probabilityCol=f"_prob_{view}", predictionCol=f"_y_{view}", maxIter=25, regParam=reg)
    return lr.fit(rows)


def _calibrated(model: LogisticRegressionModel, view: str, held: DataFrame) -> View:
    z = model.transform(held).select(vector_to_array(f"raw_{view}")[1].alias("z"), "label")
    z = VectorAssembler(inputCols=["z"], outputCol="one").transform(z)
    platt = LogisticRegression(featuresCol="one", labelCol="label", maxIter=25, regParam=1e-3).fit(z)
    return View(model, float(platt.coefficients[0]), float(platt.intercept))


def _fetched(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """The columns of chosen (one row an id, written) and the features of its ids, written.

    Few are looked up by broadcast, more by a shuffle of both sides.
    """
    names = [c for c in chosen.columns if c != "doc_id"]
    joined = texts.join(F.broadcast(chosen) if chosen.count() <= LOOKED_UP else chosen, "doc_id")
    keep = [F.col(c) for c in ("doc_id", "_k", *names)]
    rows = views_of(joined) if "_tf" in texts.columns else features(joined, "_t", "_s", "_l", keep)
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct(*names, "content", "page"), "_k").alias("_one"))
    return cut(one.select("doc_id", "_one.*"))


def _scores(rows: DataFrame, known: DataFrame, models: dict[str, LogisticRegressionModel]) -> DataFrame:
    """(doc_id, a score by each view) of every document of `counted` rows that isn't in known, written."""
    rows = views_of(rows)
    for model in models.values():
        rows = model.transform(rows)
    rows = rows.select("doc_id", "_k", *[vector_to_array(f"raw_{v}")[1].alias(f"z_{v}") for v in models])
    one = rows.groupBy("doc_id").agg(F.min(F.struct("_k", *[f"z_{v}" for v in models])).alias("_one"))
    return cut(one.select("doc_id", *[f"_one.z_{v}" for v in models]).join(known.select("doc_id"), "doc_id", "left_anti"))


def _surest(scores: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """(doc_id, label) of the n_good rows of greatest z and the n_bad of least, of (doc_id, z)."""
    placed, n = ordered_prefix(scores.withColumn("_one", F.lit(1)), ["z", "doc_id"], "_one")
    label = F.when(F.col("row") >= n - n_good, 1.0).when(F.col("row") < n_bad, 0.0)
    return placed.select("doc_id", label.alias("label")).where("label is not null")


def co_train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, rounds: int = ROUNDS):
    """({view: View}, log odds of the prior), or the share of good labels if there is but one class."""
    good_label = F.col("quality") * (1 - F.coalesce("toxic", F.lit(0))) if "toxic" in labels.columns else F.col("quality")
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min(good_label).cast("double").alias("label"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"), F.col(source_col).alias("_s"), F.col(lang_col).alias("_l")).where("doc_id is not null")
    # of rows that share an id, one is trained on
    texts = texts.withColumn("_k", F.xxhash64("_t", "_s", "_l"))
    first = lambda df, n: df.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(n).drop("_h")
    # at most LABELLED ids, whatever the input
    labelled = cut(first(known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), LABELLED))
    few = lambda df, n: df.coalesce(max(FIT_TASKS, n // FIT_ROWS))
    sample = few(_fetched(texts, labelled), LABELLED)
    apart = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(HELD_OUT)) == 0
    held, train = sample.where(apart), sample.where(~apart)
    count = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    held_classes = held.select("label").distinct().count()
    if len(count) < 2 or held_classes < 2:
        return None, count.get(1.0, 0) / sum(count.values()) if count else 1.0
    good = count[1.0] / (count[0.0] + count[1.0])

    views = ("content", "page")
    added, n_rows = dict.fromkeys(views), sum(count.values())
    # texts are read once for all rounds: what is kept of them is smaller
    rows_of = written(counted(texts, "_t", "_s", "_l", [F.col("doc_id"), F.col("_k")])) if rounds > 1 else None
    for turn in range(rounds):
        models = {v: _fit(train if added[v] is None else few(train.unionByName(added[v]), n_rows), v) for v in views}
        if turn == rounds - 1:
            break
        scores = _scores(rows_of, known, models)
        give = int(scores.count() * CONFIDENT)
        if not give:
            break
        n_good, n_bad = max(1, round(give * good)), max(1, round(give * (1 - good)))
        picked = []
        for v, other in (views, views[::-1]):
            rest = scores if added[other] is None else scores.join(added[other].select("doc_id"), "doc_id", "left_anti")
            picked.append(_surest(rest.select("doc_id", F.col(f"z_{v}").alias("z")), n_good, n_bad).withColumnRenamed("label", f"y_{other}"))
        rows = _fetched(rows_of, cut(picked[0].join(picked[1], "doc_id", "full")))
        for v in views:
            new = rows.where(F.col(f"y_{v}").isNotNull()).withColumn("label", F.col(f"y_{v}")).select(*train.columns)
            added[v] = new if added[v] is None else added[v].unionByName(new)
        n_rows += n_good + n_bad
    return {v: _calibrated(models[v], v, held) for v in views}, math.log(good / (1 - good))


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    keep: list[str] | None = None,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every row of docs, with p_content, p_page, score (chance of being good) and kept.

    labels has doc_id, quality (0 or 1) and maybe toxic; a document is good if it has quality
    and isn't toxic. An id with several labels counts as good if all are, null qualities are
    left out, a null in toxic counts as 0. Of equally sure documents those of smaller ids come
    first where the surest are taken as bad, those of greater ids where they are taken as good. Null and empty texts are scored by their page view and as texts without words.
    Repeated rows are scored alike, an empty table gives no rows, and columns of docs named as
    the ones added are left out. Without labels of both
    classes every row has the share of good labels (1 without any) as its score.
    """
    rows = _scored(docs, labels, threshold, id_col, text_col, source_col, lang_col, rounds)
    added = ("p_content", "p_page", "score", "kept")
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in own], *[F.col(f"_{c}").alias(c) for c in added])


def _scored(docs: DataFrame, labels: DataFrame, threshold: float, id_col: str, text_col: str, source_col: str, lang_col: str, rounds: int = ROUNDS) -> DataFrame:
    """(_row, _p_content, _p_page, _score, _kept), _row being the whole row."""
    views, prior = co_train(docs, labels, id_col, text_col, source_col, lang_col, rounds)
    row = F.struct(*docs.columns).alias("_row")
    if views is None:
        p = F.lit(float(prior))
        return docs.select(row, p.alias("_p_content"), p.alias("_p_page"), p.alias("_score"), (p >= threshold).alias("_kept"))
    scored = features(docs, text_col, source_col, lang_col, [row])
    for v in views.values():
        scored = v.model.transform(scored)
    scored = scored.withColumns(dict(v.log_odds(name) for name, v in views.items()))
    chance = lambda z: 1 / (1 + F.exp(-z))
    score = chance(F.col("z_content") + F.col("z_page") - prior)
    return scored.select("_row", chance(F.col("z_content")).alias("_p_content"), chance(F.col("z_page")).alias("_p_page"), score.alias("_score"), (score >= threshold).alias("_kept"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, with their columns, that the classifier doesn't reject."""
    return _scored(docs, labels, threshold, "doc_id", "text", "source", "lang").where("_kept").select("_row.*")


def op6(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
