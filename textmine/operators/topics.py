"""Topic models: fit LDA on count triplets and work with its tidy tables.

``fit_lda`` fits by MLlib's online variational Bayes, whose topic-term
matrix is k x V and lives on the driver, so the vocabulary passed in should be
bounded (stop words removed, rare terms optional), or by EM on tables
(``topic_fit.fit_em``).  Everything after the fit works on the three tidy tables:

* beta   ``(topic, term, beta)``       per-topic term distribution;
* gamma  ``(document, topic, gamma)``  per-document topic distribution;
* assignments ``(document, term, count, assigned_topic)``.

The steps after the fit (classification, consensus, augment, confusion)
only need beta and gamma tables, so they run the same on any model's output.
"""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmine.operators.topic_fit import TopicModel, fit_em
from textmine.operators.verbs import count_by, hot_and_cold, measured, separate, share, top_n, with_order
from textmine.session import stored
from textmine.sources.matrix import cast_dtm


def fit_lda(triplets: DataFrame, k: int, seed: int = 1234, optimizer: str = "online",
            max_iter: int = 100, document: str = "document", term: str = "term",
            value: str = "count"):
    """Fit LDA on count triplets.  Eager (training runs jobs).

    Returns ``(model, vectors, vocab)``; the vectors are computed once
    (a stored table) and held in memory only while the model trains.
    ``optimizer="em"`` makes the updates of MLlib's EM on blocks of documents
    instead of on a graph with an edge per cell, which passes every cell
    through several shuffles a round: its model is a ``TopicModel``.
    """
    vectors, vocab, _ = cast_dtm(triplets, document, term, value)
    if optimizer == "em":
        return fit_em(triplets, k, seed, max_iter, document=document, term=term, value=value), vectors, vocab
    lda = LDA(k=k, seed=seed, optimizer=optimizer, maxIter=max_iter, featuresCol="features")
    cached = vectors.persist()
    try:
        model = lda.fit(cached)
    finally:
        cached.unpersist()
    return model, vectors, vocab


def fitted_top_terms(model, vocab: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` terms of highest beta per topic, straight from the model:
    only k x n cells are read from it."""
    return _described(model, vocab, n).orderBy("topic", F.desc("beta"), "term")


def _described(model, vocab: DataFrame, n: int) -> DataFrame:
    cells = model.describeTopics(maxTermsPerTopic=n).select(
        (F.col("topic") + 1).cast("long").alias("topic"),
        F.inline(F.arrays_zip(F.col("termIndices").alias("index"), F.col("termWeights").alias("beta"))))
    return cells.join(vocab, "index").select("topic", "term", "beta")


def tidy_beta(model, vocab: DataFrame) -> DataFrame:
    """``(topic, term, beta)``, topics numbered from 1, beta summing to 1
    within each topic.  Of an MLlib model the whole k x V matrix, which it
    holds on the driver, is read."""
    if isinstance(model, TopicModel):
        return model.beta()
    return _described(model, vocab, model.vocabSize())


def tidy_gamma(model, vectors: DataFrame, document: str = "document") -> DataFrame:
    """``(document, topic, gamma)`` from the model's inference per document."""
    dist = model.transform(vectors).select(
        F.col(document).alias("document"), vector_to_array("topicDistribution").alias("_g"))
    return dist.select("document", F.posexplode("_g").alias("topic", "gamma")) \
               .withColumn("topic", (F.col("topic") + 1).cast("long"))


def top_terms(beta: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` terms per topic by beta (ties kept), ordered by topic, -beta."""
    return top_n(beta, n, "beta", by="topic").orderBy("topic", F.desc("beta"), "term")


def inspect_document(triplets: DataFrame, name: str, document: str = "document", term: str = "term",
                     value: str = "count") -> DataFrame:
    """The terms of one document, most frequent first."""
    return triplets.filter(F.col(document) == name).select(document, term, value).orderBy(F.desc(value), term)


def topic_log_ratio(beta: DataFrame, a: int = 1, b: int = 2, floor: float = 0.001) -> DataFrame:
    """Wide beta for topics a and b, terms with beta > floor in either,
    ``log_ratio = log2(beta_b / beta_a)``."""
    ta, tb = f"topic{a}", f"topic{b}"
    named = beta.filter(F.col("topic").isin(a, b)) \
        .withColumn("topic", F.concat(F.lit("topic"), F.col("topic").cast("string")))
    wide = named.groupBy("term").pivot("topic", [ta, tb]).agg(F.first("beta"))
    kept = wide.filter((F.col(ta) > floor) | (F.col(tb) > floor))
    return kept.withColumn("log_ratio", F.log2(F.try_divide(F.col(tb), F.col(ta))))


def classify(gamma: DataFrame, sep: str = "_") -> DataFrame:
    """Split ``document`` into ``title`` and integer ``chapter``; keep the
    topic(s) with the highest gamma per chapter (ties kept)."""
    split = separate(gamma, "document", ["title", "chapter"], sep=sep, convert={"chapter": "long"})
    return top_n(split, 1, "gamma", by=["title", "chapter"])


def consensus(classes: DataFrame) -> DataFrame:
    """Most common topic per title (ties kept): ``(consensus, topic)``."""
    counts = count_by(classes, "title", "topic")
    best = top_n(counts, 1, "n", by="title")
    return best.select(F.col("title").alias("consensus"), "topic")


def misclassified(classes: DataFrame, book_topics: DataFrame) -> DataFrame:
    """Chapters whose topic is the consensus of another title."""
    return classes.join(book_topics, "topic").filter(F.col("title") != F.col("consensus"))


def by_term(beta: DataFrame) -> DataFrame:
    """Beta as one row per term: its topics and betas, and the sum of these
    (how often the term is met, roughly) as ``_weight``."""
    return beta.filter(F.col("beta").isNotNull()).groupBy("term").agg(
        F.collect_list(F.struct("topic", "beta")).alias("_beta"), F.sum("beta").alias("_weight"))


def augment(triplets: DataFrame, beta: DataFrame, gamma: DataFrame, document: str = "document", term: str = "term",
            value: str = "count", distinct: bool = False) -> DataFrame:
    """Add ``assigned_topic`` to each document-term cell: the topic
    maximising gamma(document, topic) * beta(topic, term), the lowest topic
    on ties.  Cells are those of the document-term matrix (repeated
    (document, term) rows are summed into one cell, as casting would, unless
    the caller knows them to be ``distinct``); cells whose term is not in beta
    are dropped.

    Beta becomes one array of k entries per term and gamma one map of k
    entries per document, so a cell meets each with one join and the arg-max
    is taken within the row: no k-fold rows and no second grouping.  Cells of
    frequent terms meet a broadcast part of beta, only those of rare ones are
    shuffled for it (``hot_and_cold``).  Eager: both sides are computed and counted.
    """
    cells = triplets.select(F.col(document).alias("document"), F.col(term).alias("term"), F.col(value).alias(value))
    by_document = measured(gamma.filter(F.col("gamma").isNotNull()).groupBy("document").agg(
        F.map_from_entries(F.collect_list(F.struct("topic", "gamma"))).alias("_gamma")), large="shuffle_hash")

    def assigned(some: DataFrame, betas: DataFrame) -> DataFrame:
        if not distinct:
            some = some.groupBy("document", "term").agg(F.sum(value).alias(value))
        joined = some.join(by_document, "document").join(betas.drop("_weight"), "term")
        # a topic the document lacks scores null, which is less than any number
        scores = F.transform("_beta", lambda e: F.struct((F.col("_gamma")[e["topic"]] * e["beta"]).alias("s"),
                                                         (-e["topic"]).alias("t")))
        best = joined.select("document", "term", value, F.array_max(scores).alias("_b"))
        return best.filter(F.col("_b.s").isNotNull()).select(
            "document", "term", value, (-F.col("_b.t")).alias("assigned_topic"))

    hot, cold = hot_and_cold(by_term(beta), "_weight")
    if cold is None:
        return assigned(cells, hot)
    frequent = F.broadcast(hot.select("term"))
    return assigned(cells.join(frequent, "term", "left_semi"), hot).unionByName(
        assigned(cells.join(frequent, "term", "left_anti"), cold))


def confusion(assignments: DataFrame, book_topics: DataFrame, value: str = "count",
              sep: str = "_") -> DataFrame:
    """Weighted counts of (true title, consensus title of the assigned
    topic), with the share within each true title.  Eager: the few counts are
    computed once (the shares read them twice)."""
    by_document = count_by(assignments, "document", "assigned_topic", wt=value, name=value)
    split = separate(by_document, "document", ["title", "chapter"], sep=sep, convert={"chapter": "long"})
    joined = split.join(book_topics.withColumnRenamed("topic", "assigned_topic"), "assigned_topic")
    counts = count_by(joined, "title", "consensus", wt=value)
    return share(stored(counts), "n", by="title", out="percent")


def wrong_words(assignments: DataFrame, book_topics: DataFrame, value: str = "count",
                sep: str = "_") -> DataFrame:
    """Terms assigned to another title's topic, weighted counts, largest first."""
    split = separate(assignments, "document", ["title", "chapter"], sep=sep, convert={"chapter": "long"})
    joined = split.join(book_topics.withColumnRenamed("topic", "assigned_topic"), "assigned_topic") \
        .filter(F.col("title") != F.col("consensus"))
    return count_by(joined, "title", "consensus", "term", wt=value, sort=True)


def topic_order(gamma_split: DataFrame) -> DataFrame:
    """Display order of titles by mean(gamma * topic).  Eager."""
    means = gamma_split.groupBy("title").agg(F.avg(F.col("gamma") * F.col("topic")).alias("_m"))
    return with_order(means, "_m", "title").select("title", "ord")
