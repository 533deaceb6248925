"""Secret scan: a random forest tells secrets from look-alikes; DataFrame functions only.

Candidates are long runs of key characters with a digit in them.  Splitting a text at its
candidates gives what stands before and after each.  The forest sees a candidate's length
and character classes, how often classes change, how likely its character pairs are in the
corpus's words, how much of it is made of such words (dictionary coverage), its path, and
the words around it.  It is trained on labelled findings; where none are given, formats
that leave no doubt label a bounded sample of the corpus's own candidates
(``seed_findings``), and the forest carries that over to the doubtful ones.

The dictionary and pair counts cover all texts.  Words stay distributed and are joined;
the table of character pairs is bounded by its alphabet (41 x 41).

Defined cases: null and empty texts have no candidates; a null path is a path of its own;
repeated rows give their findings again; a null id is carried along; without labelled
findings of both classes every score is the share of secrets among them, or 0.5; an empty
table gives no rows.  Only id, text and path are read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import id_remainder
from .scratch import staged, workspace

#: The candidate's shape and the words that announce a secret.
CANDIDATE = r"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]{0,200}[0-9])[A-Za-z0-9+/_\-]{12,}+={0,2}"
ANNOUNCED = (r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api.?key|access.?key|auth|bearer"
             r"|credential|private.?key)[^A-Za-z0-9]*$")
PAIR_ALPHABET = "a-z0-9+/_=\\-"

CONTEXT = 60
#: A word is in the dictionary from this many occurrences on.
DICTIONARY_MIN = 5
#: Labelled findings a forest is trained on at most, in expectation.
TRAIN_FINDINGS = 20_000
TREES, DEPTH, SEED = 40, 7, 11

FEATURES = ["length", "digits", "lowers", "uppers", "symbols", "changes", "pair_score",
            "coverage", "longest_letters", "path_rate", "word_rate", "announced", "assigned",
            "quoted", "closed"]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = "source"
               ) -> DataFrame:
    """(doc_id, path, at, finding, before, after): every candidate of every text."""
    col = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(F.col(key).alias("doc_id"), F.col(path).alias("path"), col.alias("text")
                        ).filter(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("findings"),
        F.split("text", CANDIDATE, -1).alias("between"))
    return found.select("doc_id", "path", "between",
                        F.posexplode("findings").alias("at", "finding")).select(
        "doc_id", "path", "at", "finding",
        F.right(F.get("between", F.col("at")), F.lit(CONTEXT)).alias("before"),
        F.left(F.get("between", F.col("at") + 1), F.lit(CONTEXT)).alias("after"))


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): lower-case words of three ASCII letters and more, over all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))),
                                          "[^a-z]+")).alias("word"))
    return (words.filter(F.length("word") >= 3).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= DICTIONARY_MIN))


def _pairs(word: Column) -> Column:
    """Adjacent character pairs of a string, as an array."""
    return F.when(F.length(word) >= 2, F.transform(
        F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substring(word, i, 2)))


def pair_table(words: DataFrame) -> DataFrame:
    """(pair, log_p): how likely the second character is after the first in the words; at
    most one row per pair of PAIR_ALPHABET."""
    counts = (words.select(F.explode(_pairs(F.concat(F.lit("_"), "word", F.lit("_")))).alias("pair"),
                           "n").groupBy("pair").agg(F.sum("n").alias("n")))
    firsts = counts.groupBy(F.left("pair", F.lit(1)).alias("first")).agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(firsts), F.left("pair", F.lit(1)) == F.col("first")).select(
        "pair", F.log((F.col("n") + 0.1) / (F.col("total") + 4.1)).alias("log_p"))


def _string_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """(finding, pair_score, coverage): what depends on the corpus, per distinct finding."""
    distinct = found.select("finding").distinct()
    low = distinct.select("finding", F.explode_outer(_pairs(F.lower("finding"))).alias("pair"))
    pairs = low.join(F.broadcast(pair_table(words)), "pair", "left").groupBy("finding").agg(
        F.avg(F.coalesce("log_p", F.lit(-7.0))).alias("pair_score"))
    # letters are cut where classes change and at capitals, as in identifiers
    parts = distinct.select("finding", F.explode(F.split(
        F.regexp_replace("finding", "([a-z])([A-Z])", "$1 $2"), "[^A-Za-z]+")).alias("part"))
    parts = parts.select("finding", F.lower("part").alias("word")).filter(F.length("word") >= 3)
    covered = parts.join(words.select("word"), "word").groupBy("finding").agg(
        F.sum(F.length("word")).alias("covered"))
    return pairs.join(covered, "finding", "left").select(
        "finding", "pair_score",
        (F.coalesce("covered", F.lit(0)) / F.length("finding")).alias("coverage"))


def describe(found: DataFrame, words: DataFrame) -> DataFrame:
    """``candidates`` with the features that need no labels, and ``word`` (the one before)."""
    def share(chars: str) -> Column:
        return F.regexp_count("finding", F.lit(f"[{chars}]")) / F.length("finding")

    change = "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"
    return (found.join(_string_features(found, words), "finding")
            .withColumn("length", F.length("finding").cast("double"))
            .withColumn("digits", share("0-9")).withColumn("lowers", share("a-z"))
            .withColumn("uppers", share("A-Z")).withColumn("symbols", share("^A-Za-z0-9"))
            .withColumn("changes", F.regexp_count("finding", F.lit(change)) / F.length("finding"))
            .withColumn("longest_letters", F.coalesce(F.array_max(F.transform(
                F.split("finding", "[^A-Za-z]+"), F.length)), F.lit(0)).cast("double"))
            .withColumn("word", F.lower(F.regexp_extract("before", r"([A-Za-z]+)[^A-Za-z]*$", 1)))
            .withColumn("announced", F.col("before").rlike(ANNOUNCED).cast("double"))
            .withColumn("assigned", F.col("before").rlike(r"[:=]\s*[\"']?$").cast("double"))
            .withColumn("quoted", F.col("before").rlike(r"[\"']$").cast("double"))
            .withColumn("closed", F.col("after").rlike(r"^[\"']").cast("double")))


def seed_findings(described: DataFrame) -> DataFrame:
    """Candidates whose format leaves no doubt, with ``label`` 1 (secret) or 0.

    Secret: a value assigned to a name that announces one, a key with a provider's prefix,
    all with digits and letters.  Not: digits only, and made mostly of dictionary words."""
    mixed = (F.col("digits") > 0) & (F.col("lowers") + F.col("uppers") > 0)
    prefix = F.col("finding").rlike("^(AKIA|ASIA|AIza|ghp_|gho_|xox[bap]-|sk_live_|glpat-)")
    named = (F.col("announced") == 1) & (F.col("assigned") == 1)
    label = (F.when((F.col("lowers") + F.col("uppers")) == 0, 0)
             .when(F.col("coverage") >= 0.5, 0).when(mixed & (prefix | named), 1))
    return described.withColumn("label", label).filter("label IS NOT NULL")


def _rates(labelled: DataFrame, column: str, prior: float) -> DataFrame:
    """(column, rate): share of secrets by value of a column, drawn to ``prior``."""
    return labelled.groupBy(column).agg(
        ((F.sum("label") + 5 * prior) / (F.count("*") + 5)).alias(f"{column}_rate"))


def _sample(labelled: DataFrame, n: int, max_rows: int) -> DataFrame:
    if n <= max_rows:
        return labelled
    order = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "at", "finding"), F.lit(1 << 20))
    return labelled.filter(order < int((1 << 20) * max_rows / n))


def scan(docs: DataFrame, findings: DataFrame | None = None, key: str = "doc_id",
         text: str = "text", path: str = "source", threshold: float = 0.5,
         max_findings: int = TRAIN_FINDINGS) -> DataFrame:
    """Every candidate with ``score`` (probability of a secret) and ``secret``.

    ``findings`` are labelled findings (finding, before, after, path, label), for example
    of a review; by default the corpus's own, from ids outside one fold of five."""
    with workspace(docs.sparkSession, "secrets") as stage:
        words = stage(dictionary(docs, text), "words")
        # the scan of the texts is a job of its own: with the features' many expressions in the
        # same generated code, compiling it takes more native memory than the scan itself
        scanned = stage(candidates(docs, key, text, path), "scan")
        found = staged(describe(scanned, words), "secret-candidates")
        if findings is None:
            labelled = seed_findings(found.filter(id_remainder("doc_id", 5) != 0))
        else:
            given = findings.select(F.lit(None).cast("long").alias("doc_id"), "path",
                                    F.lit(0).alias("at"), "finding", "before", "after", "label")
            labelled = describe(given, words).filter("label IS NOT NULL")
        columns = [c for c in found.columns] + ["label"]
        labelled = staged(labelled.select(*columns), "secret-labelled")
        n, positive = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    result = ["doc_id", "path", "at", "finding", "before", "after", "score", "secret"]
    if not 0 < positive < n:
        share = positive / n if n else 0.5
        return found.withColumn("score", F.lit(float(share))).withColumn(
            "secret", F.col("score") > threshold).select(*result)
    labelled = staged(_sample(labelled, n, max_findings), "secret-sample")
    prior = positive / n
    # the values of a bounded sample's columns
    rates = {c: F.broadcast(_rates(labelled, c, prior).withColumnRenamed(c, f"_{c}"))
             for c in ("path", "word")}

    def vectors(df: DataFrame) -> DataFrame:
        for c, table in rates.items():
            df = df.join(table, F.col(c).eqNullSafe(F.col(f"_{c}")), "left").withColumn(
                f"{c}_rate", F.coalesce(f"{c}_rate", F.lit(prior))).drop(f"_{c}")
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)

    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features",
        probabilityCol="p", rawPredictionCol="raw", predictionCol="predicted")
    model = forest.fit(vectors(labelled).select("features", F.col("label").cast("double")))
    scored = model.transform(vectors(found)).withColumn("score", vector_to_array("p")[1])
    return scored.withColumn("secret", F.col("score") > threshold).select(*result)
