"""Secret scans: a random forest removes the false positives among candidate strings. DataFrame functions and Spark ML only.

Candidates are long runs with a digit or an issuer's mark, passwords in addresses (``scheme://user:password@host``), and whatever
of four characters or more is assigned to a name such as ``password`` or ``SECRET_KEY``. A forest judges each by length,
character transitions, coverage by frequent words of all documents, path-like surroundings and neighbouring words. It is
trained on labelled findings: at most ``MOST_FINDINGS`` candidates that clear rules mark as secrets (issuer formats, random
values assigned to such a name) or as harmless (numbers, addresses, words, checksums), and a made set of both kinds, so that
small tables have both too. A caller may pass findings of their own.

Null and empty texts have no candidates. Whole texts are scanned; rows with equal ids are scanned each for itself; an empty
table gives an empty result; other columns are kept by ``redacted`` and ignored by ``findings``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import staged

NAMES = "password|passwd|passphrase|passcode|pass|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth"
#: What may follow a name: SECRET_KEY, access_key_id, token2.
SUFFIX = "(?:[_-]?(?:key|id|[0-9]{1,3}))?" * 2
RUN = "[A-Za-z0-9+/_-]"
ISSUER = "AKIA|ASIA|gh[opsu]_|xox[abprs]-|[sr]k_live_|AIza"
#: What stands before the password of an address with credentials.
LOGIN = "://[^\\s/@:\"'<>]{0,64}:"
#: The password of such an address, a long run with a digit or an issuer's mark, or a value assigned to a telling name.
#: Cheap looks behind come first, so that the dear ones run only behind an assignment.
CANDIDATE = (f"(?<=:)(?<={LOGIN})[^\\s/@\"'<>]++(?=@)"
             f"|(?<!{RUN})(?=[A-Za-z+/_-]*+[0-9]|{ISSUER}){RUN}{{16,}}+={{0,2}}"
             f"|(?<=[:=\"'\\s])(?<=[:=]\\s{{0,3}}[\"']?)(?<=(?i:{NAMES})(?i:{SUFFIX})[\"']?\\s{{0,3}}[:=]\\s{{0,3}}[\"']?)[^\\s\"'<>,;]{{4,}}")
ISSUED = "^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[opsu]_[A-Za-z0-9]{36}|^xox[abprs]-|^[sr]k_live_[0-9a-zA-Z]{16}|^AIza[0-9A-Za-z_-]{35}$"
SUMS = "(?i)(commit|sha-?[0-9]*|md5|checksum|digest|uuid|etag|revision|integrity)\\W{0,6}$"
ASSIGNED = f"(?i)({NAMES}){SUFFIX}[\"']?\\s*[:=]\\s*[\"']?$"
#: Private-use characters that mark the candidates in a text; such characters in the text itself are looked at as another one.
OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"
CONTEXT = 80
MOST_FINDINGS, DICTIONARY, MADE = 20_000, 400, 1024
TREES, DEPTH, THRESHOLD = 24, 6, 0.5
MASK = "[SECRET]"
FEATURES = ["long", "class_changes", "vowel_changes", "distinct", "digits", "upper", "hex", "covered", "path", "named", "summed", "quoted", "address"]


def candidates(docs: DataFrame) -> DataFrame:
    """The documents that have candidates, with ``_row`` and ``_parts``: text and candidates in turn. Written once, so that rows keep their number."""
    marked = F.regexp_replace(F.translate("text", OPEN + CLOSE, OTHER * 2), CANDIDATE, OPEN + "$0" + CLOSE)
    found = docs.where(F.col("text").rlike(CANDIDATE)).withColumn("_parts", F.split(marked, f"[{OPEN}{CLOSE}]"))
    return staged(found.withColumn("_row", F.monotonically_increasing_id()), "secret-candidates")


def exploded(found: DataFrame) -> DataFrame:
    """One row per candidate: _row, number, start (in characters), value, and what stands before and after it."""
    row = Window.partitionBy("_row").orderBy("pos")
    parts = found.select("_row", F.posexplode("_parts").alias("pos", "part"))
    parts = (parts.withColumn("start", F.sum(F.length("part")).over(row) - F.length("part"))
             .withColumn("before", F.coalesce(F.lag(F.right("part", F.lit(CONTEXT))).over(row), F.lit("")))
             .withColumn("after", F.coalesce(F.lead(F.left("part", F.lit(CONTEXT))).over(row), F.lit(""))))
    return parts.where(F.col("pos") % 2 == 1).select("_row", F.expr("pos div 2").alias("number"), "start", F.col("part").alias("value"), "before", "after")


def frequent_words(docs: DataFrame) -> list[str]:
    """The ``DICTIONARY`` most frequent words of four to ten letters, counted over all texts."""
    words = docs.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("word")).where(F.length("word").between(4, 10))
    return [r[0] for r in words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(DICTIONARY).collect()]


def judged_by(rows: DataFrame, words: list[str]) -> DataFrame:
    """Adds the forest's features to rows of value, before and after."""
    value, size = F.col("value"), F.length("value")
    share = lambda pattern: F.regexp_count(value, F.lit(pattern)) / size
    covered = (size - F.length(F.regexp_replace(F.lower(value), "|".join(sorted(words, key=lambda w: (-len(w), w))), ""))) / size if words else F.lit(0.0)
    login = F.col("before").rlike(LOGIN + "$") & F.col("after").startswith("@")
    made = {
        "long": size, "class_changes": share("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])"),
        "vowel_changes": share("(?i)[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))), "digits": share("[0-9]"), "upper": share("[A-Z]"), "hex": share("[0-9a-f]"),
        "covered": covered, "path": ~login & (F.right("before", F.lit(CONTEXT // 2)).rlike("[/\\\\]$|https?:") | value.contains("/") | F.col("after").rlike("^[/\\\\]|^\\.[a-z]{2,4}\\b")),
        "named": F.col("before").rlike(ASSIGNED) | login, "summed": F.col("before").rlike(SUMS), "quoted": F.col("before").rlike("[\"']$"),
        "address": ~login & (F.col("after").rlike("^@") | value.contains("@")),
    }
    return rows.select("*", *[c.cast("double").alias(k) for k, c in made.items()])


def _rule() -> Column:
    """1 for clear secrets, 0 for clear false positives, null for the rest."""
    random = (F.col("distinct") >= 8) & (F.col("digits") > 0) & (F.col("digits") < 1) & (F.col("covered") < 0.5)
    harmless = (F.col("digits") == 1) | (F.col("address") == 1) | (F.col("summed") == 1) | (F.col("distinct") <= 4) | (F.col("covered") > 0.6)
    return F.when(F.col("value").rlike(ISSUED), 1.0).when(harmless, 0.0).when((F.col("named") == 1) & random, 1.0)


def made_findings(docs: DataFrame, words: list[str]) -> DataFrame:
    """Labelled values in the usual surroundings, from hashes of numbers: random keys and passwords, and their look-alikes."""
    h = F.md5(F.col("id").cast("string"))
    word = lambda k: F.element_at(F.array(*map(F.lit, words or ["word"])), (F.conv(F.substring(h, k, 6), 16, 10).cast("long") % max(1, len(words)) + 1).cast("int"))
    spoken = F.concat(*[F.translate(F.substring(h, k, 1), "0123456789abcdef", to) for k in range(1, 9) for to in [["aeiouaeiouaeioua", "bdfglmnprstvkchz"][k % 2]]])
    letters = F.translate(F.substring(h, 1, 12), "0123456789", "ghjkmnpqrs")
    kinds = [
        (F.substring(h, 1, 18), F.lit("password="), F.lit(" "), 1.0), (F.concat(h, F.substring(h, 3, 8)), F.lit('token = "'), F.lit('" '), 1.0),
        (F.concat(F.lit("AKIA"), F.translate(F.upper(F.substring(h, 1, 16)), "01", "QZ")), word(1), F.lit(" "), 1.0), (F.base64(F.unhex(h)), F.lit("secret: "), F.lit("\n"), 1.0),
        (F.translate(F.substring(h, 1, 16), "abcdef", "123456"), word(1), F.lit(" "), 0.0), (F.concat(h, F.substring(h, 1, 8)), F.lit("commit "), F.lit("\n"), 0.0),
        (F.concat_ws("-", word(1), word(7), word(13), F.substring(h, 30, 1)), word(20), F.lit(" "), 0.0), (F.concat_ws("/", word(1), word(9), h), F.lit("https://"), F.lit(".html"), 0.0),
        (F.substring(F.base64(F.unhex(h)), 1, 7), F.lit("db_pass="), F.lit("\n"), 1.0), (letters, F.lit("SECRET_KEY="), F.lit("\n"), 1.0),
        (F.concat(F.lit("AKIA"), F.translate(F.upper(F.substring(h, 1, 16)), "0123456789", "QZXWVUTSRP")), F.lit("aws_access_key_id="), F.lit("\n"), 1.0),
        (F.concat(F.substring(spoken, 1, 6), F.substring(h, 20, 2)), F.lit("passphrase: "), F.lit("\n"), 1.0),
        (F.substring(F.base64(F.unhex(h)), 3, 9), F.lit("postgres://admin:"), F.lit("@db"), 1.0), (spoken, F.lit("secret: "), F.lit(" "), 0.0),
        (word(1), F.lit("password: "), F.lit(" "), 0.0), (F.substring(spoken, 1, 6), F.lit("auth: "), F.lit(" "), 0.0),
    ]
    value, before, after = (F.element_at(F.array(*[k[i] for k in kinds]), (F.col("id") % len(kinds) + 1).cast("int")) for i in range(3))
    label = F.element_at(F.array(*[F.lit(k[3]) for k in kinds]), (F.col("id") % len(kinds) + 1).cast("int"))
    return docs.sparkSession.range(MADE).select(value.alias("value"), before.alias("before"), after.alias("after"), label.alias("label"))


def forest(docs: DataFrame, rows: DataFrame, words: list[str], labelled: DataFrame | None) -> RandomForestClassificationModel:
    if labelled is None:
        marked = rows.withColumn("label", _rule()).where("label is not null").select("value", "before", "after", "label", *FEATURES)
        marked = marked.orderBy(F.xxhash64("value", "before", "after"), "value").limit(MOST_FINDINGS).drop("value", "before", "after")
        labelled = marked.unionByName(judged_by(made_findings(docs, words), words).select("label", *FEATURES))
    else:
        labelled = judged_by(labelled, words).select("label", *FEATURES)
    labelled = staged(labelled, "secret-labelled").orderBy("label", *FEATURES).coalesce(1)
    made = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5).fit(made)


def scored(docs: DataFrame, found: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per candidate: _row, number, start, value, score (the forest's share for a secret) and is_secret."""
    words = frequent_words(docs)
    rows = staged(judged_by(exploded(found), words), "secret-features")
    model = forest(docs, rows, words, labelled)
    out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    score = vector_to_array("probability")[1]
    return out.select("_row", "number", "start", "value", score.alias("score"), (score >= THRESHOLD).alias("is_secret"))


def findings(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of every document: doc_id, start and length in characters, the value's SHA-256, score, is_secret."""
    docs = docs.select("doc_id", "text")
    found = candidates(docs)
    return (scored(docs, found, labelled).join(found.select("_row", "doc_id"), "_row")
            .select("doc_id", "start", F.length("value").alias("length"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", "is_secret"))


def redacted(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """All documents, secrets replaced by ``MASK``; ``n_chars``, where there is one, is counted anew. Columns as they were."""
    names = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], "text")
    found = candidates(inner)
    hits = (scored(inner.select("text"), found, labelled).groupBy("_row")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "is_secret"))), lambda x: x["is_secret"]).alias("hits")))
    # parts of a text that holds the marks itself were looked at with another character for them: their places in the text count
    place = lambda i: F.aggregate(F.slice("_parts", 1, i), F.lit(0), lambda n, p: n + F.length(p))
    own = lambda p, i: F.when(F.col("text").rlike(f"[{OPEN}{CLOSE}]"), F.substr(F.col("text"), place(i) + 1, F.length(p))).otherwise(p)
    masked = F.array_join(F.transform("_parts", lambda p, i: F.when((i % 2 == 1) & F.get("hits", F.floor(i / 2).cast("int")), F.lit(MASK)).otherwise(own(p, i))), "")
    text, count = f"c{names.index('text')}", f"c{names.index('n_chars')}" if "n_chars" in names else None
    changed = found.join(hits, "_row").withColumn("_new", F.when(F.exists("hits", lambda h: h), masked).otherwise(F.col("text")))
    columns = [F.col("_new").alias(text) if c == text else F.when(F.exists("hits", lambda h: h), F.length("_new").cast(inner.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == count else F.col(c)
               for c in (f"c{i}" for i in range(len(names)))]
    same = inner.where(F.col("text").isNull() | ~F.col("text").rlike(CANDIDATE)).drop("text")
    return same.unionByName(changed.select(*columns)).toDF(*names)
