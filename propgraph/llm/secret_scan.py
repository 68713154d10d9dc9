"""Secret scan: wide candidates, and a random forest that removes false ones.

Every maximal run of ``[A-Za-z0-9+/=_@.:%-]`` is read, whatever surrounds it and
however many a word holds. A candidate is a run (or its value and its name, if
it is ``name=value`` or ``name:value``) of at least ``MIN_LENGTH`` characters
that is no plain word (letters without a digit, lower case after the first).
After a credential's name and a sign (``password=``, ``"api_key":``, ``DB_KEY2 =``)
the value may hold any characters up to its quote, or unquoted up to a blank or
one of ``"'`,;&<>)}]``, and counts from ``MIN_CREDENTIAL`` characters. The forest
sees the value's length, its character transitions, how much of it dictionary
words cover, how path-like it is, and the words around it; it never sees the
value itself. Labelled findings train it: given ones, or
those the strict rules of ``label_findings`` label (known key formats and
credential assignments of mixed values against addresses, numbers and the
like), at most ``max_train`` of them, chosen by hash.

Everything is a DataFrame expression or Spark ML (JVM): no Python on executors
and no shuffle on the scan path. Only digests and lengths of values are returned.

Cases: null or empty text has no candidates; a text may have many, also the
same one repeatedly (told apart by word position and part); an empty table gives an
empty result; with labels of one class only every score is that class; extra
columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propgraph.llm.common import checkpointed

MIN_LENGTH = 12
MIN_CREDENTIAL = 4
MAX_TRAIN = 20_000

# Words that stand before a credential, and words common inside
# addresses, paths and placeholders.
CREDENTIAL_WORDS = ["password", "passwd", "pwd", "token", "secret", "apikey", "key", "credential",
                    "credentials", "auth", "bearer"]
DICTIONARY = ["example", "sample", "placeholder", "changeme", "dummy", "test", "user", "admin", "name",
              "mail", "email", "http", "https", "www", "com", "org", "net", "html", "index", "page",
              "file", "path", "data", "image", "version", "build", "release", "january", "february",
              "march", "april", "june", "july", "august", "september", "october", "november",
              "december", "null", "none", "true", "false", "localhost", "default", "config"]

FEATURES = ["length", "kinds", "letter_digit", "digit_letter", "case_change", "symbol_runs", "run_share",
            "digit_share", "dictionary_share", "slashes", "dots", "at_signs", "has_extension",
            "name_credential", "before_credential", "after_letters"]


RUN = "[A-Za-z0-9+/=_@.:%-]"
PLAIN = "^[A-Z]?[a-z]+$"
CLOSE, SIGN = r"[\x22'`\])\\]*+", r"[=:]+>?\\*+"
#: A credential word in a name without separators; the word found is one of CREDENTIAL_WORDS.
REDUCED = "password|passwd|pwd|token|secret|apikey|credentials|credential|bearer|key$|auth$"
CREDENTIAL = (r"(?:(?:password|passwd|pwd|token|secret|api[_-]?key|credential|bearer)[A-Za-z0-9_.-]*?"
              r"|(?:key|auth)[0-9_.-]*)")
#: name, sign and value of a credential in one word; of any name; a run.
ASSIGNED = (rf"(?i:{RUN}*?{CREDENTIAL}){CLOSE}{SIGN}"
            r"(?:\x22[^\x22]+|'[^']+|`[^`]+|[^\x20\x09-\x0D\x22'`,;&<>)}\]]+)")
NAMED = rf"(?:[A-Za-z_][A-Za-z0-9_.-]*+{CLOSE}{SIGN}[\x22'`(]+)?{RUN}+"


def candidates(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, pos, part, name, value, before, after) of every candidate; pos is
    the 0-based position among the text's words, part tells those of a word apart."""
    words = F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1)
    run = rf"{RUN}{{{min_length},}}"
    # a credential's name and a sign, somewhere in the text or around a word
    signed = r"(?i)(?:password|passwd|pwd|token|secret|key|credential|bearer|auth)[^\x20\x09-\x0D]*[\x20\x09-\x0D]*[=:]"
    name_end = rf"(?i){CREDENTIAL}[\x22'`\])\\]*$"
    name_sign = rf"(?i){CREDENTIAL}[\x22'`\])\\]*[=:]+>?$"

    def after_name(word: Column, b1: Column, b2: Column) -> Column:
        return F.coalesce(b1.rlike(name_sign) | (b1.rlike("^[=:]+>?$") & b2.rlike(name_end))
                          | (word.rlike("^[=:]+>?[^=:>]") & b1.rlike(name_end)), F.lit(False))

    def word_at(i: Column) -> Column:
        return F.when((i >= 0) & (i < F.size("_words")), F.get("_words", i))

    picked = F.filter(F.transform("_words", lambda x, i: F.when(
        ((F.char_length(x) >= min_length) & x.rlike(run) & ~x.rlike(r"^[\x22'(]*[A-Z]?[a-z]+[\x22'.,;:!?)]*$"))
        | (F.col("_signed") & (x.rlike(signed) | after_name(x, word_at(i - 1), word_at(i - 2)))),
        F.struct(i.alias("pos"), x.alias("word")))), lambda c: c.isNotNull())
    near = F.transform(picked, lambda c: F.struct(
        c["pos"].alias("pos"), c["word"].alias("word"),
        *[word_at(c["pos"] - k).alias(n) for k, n in ((1, "b1"), (2, "b2"), (-1, "a1"))]))
    found = (docs.select("doc_id", "text").where(F.col("text").rlike(f"{run}|{signed}"))
             .select("doc_id", words.alias("_words"), F.col("text").rlike(signed).alias("_signed"))
             .select("doc_id", F.explode(near).alias("c")).select("doc_id", "c.*"))
    # a value apart from its name is read as one behind a name of its own
    apart = after_name(F.col("word"), F.col("b1"), F.col("b2")) & ~F.col("word").rlike(ASSIGNED)
    said = F.when(F.col("_apart"), F.concat(F.lit("key="), F.regexp_replace("word", "^[=:]+>?", ""))).otherwise(F.col("word"))
    items = (found.withColumn("_apart", apart).withColumn("_signed_before", F.col("b1").rlike("[=:]>?$"))
             .select("*", F.posexplode(F.regexp_extract_all(said, F.lit(f"{ASSIGNED}|{NAMED}"), F.lit(0))).alias("_k", "_m")))
    secret = rf"^({RUN}*?(?i:{CREDENTIAL})){CLOSE}{SIGN}([\x22'`]?)(.+)$"
    split = (rf"^([A-Za-z_-]+(?=[=:])|[A-Za-z_][A-Za-z0-9_.-]*(?=[\x22'`\])\\=]|:+>?\\*[\x22'`(]))"
             rf"{CLOSE}{SIGN}[\x22'`(]*(.*[A-Za-z0-9].*)$")
    m, is_secret = F.col("_m"), F.col("_m").rlike(f"^(?:{ASSIGNED})$")
    trim = lambda c: F.regexp_replace(c, r"^[=:]+|[.:]+$", "")
    clean = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]+", "")
    short = lambda c: F.when(c.rlike(REDUCED), F.regexp_extract(c, REDUCED, 0)).otherwise(c)
    raw = F.regexp_extract(m, secret, 3)
    quoted = F.regexp_extract(m, secret, 2) != ""
    bare = F.regexp_replace(raw, r"\\+$", "")
    given = F.when(is_secret, F.regexp_extract(m, secret, 1)).otherwise(F.regexp_extract(m, split, 1))
    own = F.col("_apart") & (F.col("_k") == 0)  # the name is the word before
    is_named = is_secret | m.rlike(split)
    piece = lambda part, name, value, known: F.struct(
        (F.col("_k") * 2 + part).alias("part"), name.alias("name"), value.alias("value"), known.alias("known"))
    pieces = F.array(
        piece(0, F.when(is_named & ~own, short(clean(given))).otherwise(F.lit("")),
              F.when(is_secret, F.when(quoted, bare).otherwise(F.regexp_replace(bare, "[.:?]+$", "")))
              .when(m.rlike(split), trim(F.regexp_extract(m, split, 2))).otherwise(trim(m)), is_secret),
        piece(1, F.lit(""), F.when(is_named & ~own, trim(given)).otherwise(F.lit("")), F.lit(False)))
    # 'token = "value"': the word before the sign is the name's place
    before = clean(F.when(F.col("b1").rlike("^[=:]+>?$"), F.col("b2")).otherwise(F.col("b1")))
    rows = (items.select("doc_id", "pos", F.explode(pieces).alias("p"),
                         F.when(F.col("_apart") | F.col("_signed_before"), short(before)).otherwise(before).alias("before"),
                         clean(F.col("a1")).alias("after"))
            .select("doc_id", "pos", "p.*", "before", "after"))
    v = F.col("value")
    wide = (F.char_length(v) >= min_length) & v.rlike(f"^{RUN}+$") & v.rlike("[A-Za-z0-9]") & ~v.rlike(PLAIN)
    return (rows.where(wide | (F.col("known") & (F.char_length(v) >= MIN_CREDENTIAL)))
            .select("doc_id", "pos", "part", "name", "value", "before", "after"))


def _times(value: Column, pattern: str) -> Column:
    """Non-overlapping matches of a pattern."""
    return F.size(F.regexp_extract_all(value, F.lit(pattern), F.lit(0)))


def features(rows: DataFrame) -> DataFrame:
    """``rows`` of ``candidates`` with the ``FEATURES`` columns (double)."""
    v, n = F.col("value"), F.char_length("value")
    # one letter per run of a character class: b1beb5 -> a9a9
    runs = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        v, "[^A-Za-z0-9]+", "-"), "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "9")
    covered = F.char_length(F.regexp_replace(F.lower(v), "(?:" + "|".join(DICTIONARY) + ")", ""))
    credential = lambda c: F.col(c).isin(CREDENTIAL_WORDS)
    r = F.col("_runs")
    made = {
        "length": n, "kinds": sum((v.rlike(k).cast("int") for k in ("[a-z]", "[A-Z]", "[0-9]")), F.lit(0)),
        "letter_digit": _times(r, "[aA](?=9)"), "digit_letter": _times(r, "9(?=[aA])"),
        "case_change": _times(r, "a(?=A)") + _times(r, "A(?=a)"), "symbol_runs": _times(r, "-"),
        "run_share": F.char_length(r) / n,
        "digit_share": F.char_length(F.regexp_replace(v, "[^0-9]+", "")) / n,
        "dictionary_share": F.lit(1.0) - covered / n,
        "slashes": _times(v, "/"), "dots": _times(v, r"\."), "at_signs": _times(v, "@"),
        "has_extension": v.rlike(r"\.[A-Za-z]{2,4}$"),
        "name_credential": credential("name"), "before_credential": credential("before"),
        "after_letters": F.char_length("after"),
    }
    return rows.withColumn("_runs", runs).select(
        *rows.columns, *[made[f].cast("double").alias(f) for f in FEATURES])


def label_findings(rows: DataFrame) -> DataFrame:
    """Strict labels: 1 for known key formats and credential assignments of
    values without words or structure (short ones only behind their name and
    sign in one word), else 0."""
    v = F.col("value")
    key_format = v.rlike(r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk-[A-Za-z0-9]{20,}$")
    assigned = F.col("name").isin(CREDENTIAL_WORDS) | F.col("before").isin(CREDENTIAL_WORDS)
    mixed = v.rlike("[A-Za-z]") & v.rlike("[0-9]") & ~v.rlike(r"[@./:]") & (
        (F.char_length("value") >= 16) | (F.col("name").isin(CREDENTIAL_WORDS) & (F.char_length("value") >= 8)))
    return rows.withColumn("label", (key_format | (assigned & mixed)).cast("double"))


def train_forest(findings: DataFrame, max_train: int = MAX_TRAIN, trees: int = 20, depth: int = 6,
                 seed: int = 11):
    """A forest fitted on labelled findings (``FEATURES`` and label), or the
    class itself if there is only one."""
    few = checkpointed(findings.select(*FEATURES, "label", F.xxhash64("doc_id", "pos").alias("_r"))
                       .orderBy("_r", *FEATURES).limit(max_train).select(*FEATURES, "label"))
    classes = [r["label"] for r in few.select("label").distinct().collect()]
    if len(classes) < 2:
        return classes[0] if classes else 0.0
    data = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(few)
    return RandomForestClassifier(featuresCol="_x", labelCol="label", numTrees=trees, maxDepth=depth,
                                  featureSubsetStrategy="onethird", seed=seed).fit(data)


def score_findings(rows: DataFrame, model) -> DataFrame:
    """``rows`` with ``score``, the forest's probability of a real secret."""
    if isinstance(model, float):
        return rows.withColumn("score", F.lit(model))
    x = VectorAssembler(inputCols=FEATURES, outputCol="_x").transform(rows)
    return (model.setPredictionCol("_p").setRawPredictionCol("_raw").setProbabilityCol("_prob")
            .transform(x).withColumn("score", vector_to_array("_prob")[1])
            .drop("_x", "_p", "_raw", "_prob"))


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5,
                 max_train: int = MAX_TRAIN) -> DataFrame:
    """One row per candidate: doc_id, pos, part, value_sha256, n_chars, score, kept
    (score at least ``threshold``: not removed as a false positive)."""
    rows = features(candidates(docs))
    slim = checkpointed(label_findings(rows).select(
        "doc_id", "pos", "part", F.sha2("value", 256).alias("value_sha256"),
        F.char_length("value").alias("n_chars"), *FEATURES, "label"))
    model = train_forest(labelled if labelled is not None else slim, max_train)
    scored = score_findings(slim.drop("label"), model)
    return scored.select("doc_id", "pos", "part", "value_sha256", "n_chars", F.round("score", 6).alias("score"),
                         (F.col("score") >= threshold).alias("kept"))
