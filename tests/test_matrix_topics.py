from pyspark.sql import functions as F

from conftest import rows
from textmine.operators import topics as TM
from textmine.sources import matrix as M


def triplets(spark):
    data = [("d1", "apple", 3), ("d1", "pear", 1), ("d2", "apple", 1), ("d2", "zebra", 7), ("d3", "lion", 2)]
    return spark.createDataFrame(data, "document string, term string, count long")


def test_cast_and_tidy_round_trip(spark):
    vectors, vocab, size = M.cast_dtm(triplets(spark))
    assert size == 4
    assert rows(vocab) == [("apple", 0), ("lion", 1), ("pear", 2), ("zebra", 3)]
    back = M.tidy_dtm(vectors, vocab)
    assert rows(back) == [(d, t, float(c)) for d, t, c in rows(triplets(spark))]


def test_lda_tables_are_distributions(spark):
    data = [(f"t{i % 2}_{i}", w, 1 + (i * 7 + j) % 5) for i in range(12)
            for j, w in enumerate(["sun", "sea", "sand"] if i % 2 else ["snow", "ice", "sea"])]
    trip = spark.createDataFrame(data, "document string, term string, count long")
    model, vectors, vocab = TM.fit_lda(trip, k=2, seed=1, max_iter=5)
    beta = TM.tidy_beta(model, vocab)
    for r in beta.groupBy("topic").agg(F.sum("beta").alias("s")).collect():
        assert abs(r.s - 1.0) < 1e-9
    gamma = TM.tidy_gamma(model, vectors)
    assert gamma.count() == 24
    for r in gamma.groupBy("document").agg(F.sum("gamma").alias("s")).collect():
        assert abs(r.s - 1.0) < 1e-9
    assert TM.classify(gamma).count() >= 12


def test_post_fit_steps_on_fixed_model(spark):
    gamma = spark.createDataFrame([
        ("A_1", 1, 0.9), ("A_1", 2, 0.1), ("A_2", 1, 0.2), ("A_2", 2, 0.8), ("A_3", 1, 0.7), ("A_3", 2, 0.3),
        ("B_1", 1, 0.1), ("B_1", 2, 0.9), ("B_2", 1, 0.5), ("B_2", 2, 0.5)],
        "document string, topic long, gamma double")
    classes = TM.classify(gamma)
    assert rows(classes, "title", "chapter", "topic") == [
        ("A", 1, 1), ("A", 2, 2), ("A", 3, 1), ("B", 1, 2), ("B", 2, 1), ("B", 2, 2)]
    book = TM.consensus(classes)
    assert rows(book) == [("A", 1), ("B", 2)]
    wrong = TM.misclassified(classes, book)
    assert rows(wrong, "title", "chapter", "consensus") == [("A", 2, "B"), ("B", 2, "A")]
    beta = spark.createDataFrame([(1, "x", 0.9), (2, "x", 0.1), (1, "y", 0.1), (2, "y", 0.9)],
                                 "topic long, term string, beta double")
    trip = spark.createDataFrame([("A_1", "x", 2), ("A_1", "y", 1), ("B_1", "y", 4)],
                                 "document string, term string, count long")
    assigned = TM.augment(trip, beta, gamma)
    assert rows(assigned) == [("A_1", "x", 2, 1), ("A_1", "y", 1, 1), ("B_1", "y", 4, 2)]
    conf = TM.confusion(assigned, book)
    assert rows(conf) == [("A", "A", 3, 1.0), ("B", "B", 4, 1.0)]
    ratio = TM.topic_log_ratio(beta, 1, 2)
    assert rows(ratio, "term", "log_ratio")[0][1] < 0


def test_shared_consensus_topic_multiplies_rows(spark):
    gamma = spark.createDataFrame([("A_1", 1, 0.9), ("A_1", 2, 0.1), ("B_1", 1, 0.8), ("B_1", 2, 0.2)],
                                  "document string, topic long, gamma double")
    classes = TM.classify(gamma)
    book = TM.consensus(classes)
    assert rows(book) == [("A", 1), ("B", 1)]
    assert rows(TM.misclassified(classes, book), "title", "consensus") == [("A", "B"), ("B", "A")]
