"""Secrets in texts: candidates by pattern, false positives removed by a random forest. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.llm.tables import column, fresh, held_out, written

_EDGE = r"[\p{L}\p{N}+/_-]"
_SECRET = r"(?i:passw(?:or)?d|passphrase|pwd|secret|token|(?:api|access|private)[_-]?key)"
# What a secret's name may go on with, up to four times (lookbehinds take no repeated choices).
_PART = (
    r"(?:[_-](?:for|of|on|in|prod(?:uction)?|dev(?:elopment)?|stag(?:e|ing)|test(?:ing)?|live|local|main|admin|root|user"
    r"|db|database|app|api|web|key|value|hash|string|base64|old|new|[0-9]{1,4}))?"
)
_MORE = f"(?i:{_PART * 4})"
_ASSIGNED = rf"{_SECRET}{_MORE}[\"'`\]]{{0,2}}\s{{0,4}}(?::=|=>|==?|:)\s{{0,4}}[\"'`]?"
#: A character of a value: any but spaces and a quote that ends it.
_ONE = r"(?:(?![\"'`](?:[\s,;:.)\]}>]|$))\S)"
#: What is assigned to a secret's name: six or more characters up to a space or closing quote, without
#: the punctuation behind it. What stands right before is looked at first, as it is cheap.
_VALUE = (
    rf"(?<=[=:>\s\"'`])(?={_ONE}{{6}})(?<=[=:>]\s{{0,4}}[\"'`]?)(?<={_ASSIGNED})"
    rf"(?![\"'`=:>]){_ONE}+(?:(?<![,;.)\]}}>])|(?=[\"'`]))"
)
#: Assigned values, and strings of at least 12 such characters with a digit, of 16 capitals, or of 24 without a digit.
CANDIDATE = (
    rf"{_VALUE}|(?<!{_EDGE})(?:(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{12,}}|[A-Z]{{16,}}|[A-Za-z+/_-]{{24,}})(?!{_EDGE})"
)
#: At most about this many findings of each label are learned from.
SAMPLE = 4000
TREES, DEPTH = 20, 6
#: The dictionary: words that occur at least so often, and are at least this share of all words.
WORD = r"(?<![\p{L}\p{N}])[a-z]{3,}(?![\p{L}\p{N}])"
LEAST_OCCURRENCES, LEAST_SHARE = 20, 1e-6
MASK = "<secret>"

_NAMES = r"(?i)(passw|passwd|pwd|secret|token|api|key|auth|bearer|credential|private)"
_SAMPLES = r"(?i)(example|sample|dummy|test|mock|fixture|placeholder|xxxx)"
_FEATURES = [
    "length", "digits", "upper", "lower", "switches", "hexadecimal", "transition", "coverage", "named", "assigned", "quoted",
    "near_sample", "near_words", "path_sample",
]


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """Every candidate with its place and what stands around it: a written table, as rows get numbers.

    Columns: ``row`` (of the document), ``number`` (of the candidate in it), ``doc_id``, ``digest`` (of
    the text), ``path``, ``candidate``, ``start`` and ``length`` in characters, ``before`` (64
    characters, as far back as the candidate before the last one), ``after`` (32). Null and empty texts have none.
    """
    rows = docs.select(
        column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"), column(path).cast("string").alias("path")
    ).filter(F.col("text").rlike(CANDIDATE))
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    pieces = F.split("text", CANDIDATE, -1)
    around = F.transform(pieces, lambda p: F.struct(
        F.length(p).alias("n"), F.right(p, F.lit(64)).alias("tail"), F.left(p, F.lit(32)).alias("head")))
    # A candidate may stand right before another one, as a name before its value.
    near = F.transform("found", lambda c: F.right(c, F.lit(64)))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "path", F.sha2("text", 256).alias("digest"),
        found.alias("found"), around.alias("around"),
    )
    n = F.size("found")
    none = F.array(F.lit(""))
    each = F.arrays_zip(
        F.col("found").alias("candidate"), F.slice("around", 1, n).alias("left"), F.slice("around", 2, n).alias("right"),
        F.slice(F.concat(none, near), 1, n).alias("last"), F.slice(F.concat(none, F.col("around.tail")), 1, n).alias("far"),
    )
    rows = rows.select("row", "doc_id", "path", "digest", F.posexplode(each).alias("number", "f"))
    size = F.length("f.candidate")
    rows = written(rows.select(
        "row", "number", "doc_id", "digest", "path", "f.candidate", size.alias("length"), F.col("f.left.n").alias("gap"),
        F.right(F.concat("f.far", "f.last", "f.left.tail"), F.lit(64)).alias("before"), F.col("f.right.head").alias("after"),
    ), "findings")
    upto = Window.partitionBy("row").orderBy("number")
    start = F.sum(F.col("gap") + F.col("length")).over(upto) - F.col("length")
    return rows.withColumn("start", start.cast("long")).drop("gap")


def dictionary(
    docs: DataFrame, text: str = "text", least: int = LEAST_OCCURRENCES, share: float = LEAST_SHARE,
) -> DataFrame:
    """Rows (word, n): the words of all documents that occur often enough, counted before the shuffle.

    Words are three letters or more that no letter or digit stands beside. What is often enough grows
    with the corpus, so that pieces of random strings do not become words as it does.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(column(text).cast("string")), F.lit(WORD), F.lit(0))).alias("word"))
    counts = written(words.groupBy("word").agg(F.count("*").alias("n")), "dictionary")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") >= max(least, share * total))


def _transitions(words: DataFrame) -> Column:
    """Log-probabilities of one letter after another in the dictionary, as a map: at most 26 by 26."""
    pairs = words.select("n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    share = F.log((F.col("n") + 1) / (F.sum("n").over(Window.partitionBy(F.substring("pair", 1, 1))) + 26))
    known = counts.select("pair", share.alias("p")).orderBy("pair").collect()
    return F.create_map(*[F.lit(x) for r in known for x in (r["pair"], r["p"])]) if known else F.create_map().cast("map<string,double>")


def _share(pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Findings with the numbers that the forest looks at.

    Of the candidate: length, shares of kinds of characters, switches between kinds, mean log-probability
    of its letter transitions and the share of it that is dictionary words. Of its surroundings: names
    like "token" before it, an assignment, quotes, words like "example", and such words in the path.
    """
    table = _transitions(words)
    strings = found.select("candidate").distinct()
    runs = strings.select("candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = runs.join(words.select("word"), "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("in_words"))
    pairs = F.transform(
        F.sequence(F.lit(1), F.length("candidate") - 1), lambda i: F.substring(F.lower("candidate"), i, F.lit(2)))
    unlikely = F.lit(-8.0)
    total = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.coalesce(F.try_element_at(table, p), unlikely))
    kinds = F.col("candidate")
    for kind, one in (("[0-9]+", "0"), ("[a-z]+", "a"), ("[A-Z]+", "A"), ("[+/_-]+", "_")):
        kinds = F.regexp_replace(kinds, kind, one)
    strings = strings.join(covered, "candidate", "left").select(
        "candidate", _share("[0-9]").alias("digits"), _share("[A-Z]").alias("upper"), _share("[a-z]").alias("lower"),
        ((F.length(kinds) - 1) / F.length("candidate")).alias("switches"),
        F.col("candidate").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hexadecimal"),
        (total / (F.length("candidate") - 1)).alias("transition"),
        (F.coalesce("in_words", F.lit(0)) / F.length("candidate")).alias("coverage"),
    )
    near = F.concat_ws(" ", "before", "after")
    return found.join(strings, "candidate").withColumns({
        "named": F.regexp_extract("before", r"(\S*\s*\S*\s*)$", 1).rlike(_NAMES).cast("double"),
        "assigned": F.col("before").rlike(r"[=:]>?\s*[\"'`]?$").cast("double"),
        "quoted": (F.col("before").rlike(r"[\"'`]$") & F.col("after").rlike(r"^[\"'`]")).cast("double"),
        "near_sample": near.rlike(_SAMPLES).cast("double"),
        "near_words": (F.length(F.regexp_replace(near, r"[^\p{L}]", "")) / (F.length(near) + 1)),
        "path_sample": F.coalesce(F.col("path").rlike(_SAMPLES), F.lit(False)).cast("double"),
    })


def labelled_by_form(found: DataFrame) -> DataFrame:
    """Label findings whose form settles the matter, as no table has labels; all others get none.

    1: an access key id with its provider's prefix, or a mixed string (also of small letters and
    capitals) assigned to a name like "password". 0: digits only (numbers of cards, accounts, phones) or letters only, unless assigned to
    such a name.
    """
    key = F.col("candidate").rlike("^(?:AKIA|ASIA)[0-9A-Z]{16}$")
    assigned = F.col("before").rlike(f"{_ASSIGNED}$")
    plain = F.col("candidate").rlike("^(?:[0-9+/_-]+|[A-Za-z+/_-]+)$")
    return found.withColumn("label", F.when(key, 1).when(plain & ~assigned, 0).when(assigned & (~plain | F.col("candidate").rlike("[a-z][A-Z]")), 1).cast("double")).filter("label IS NOT NULL")


@dataclass
class Scanner:
    """A fitted forest, or the only label that there was to learn."""

    forest: Model | None
    constant: float

    def score(self, rows: DataFrame) -> DataFrame:
        """Featured findings with ``score``, the forest's probability that they are secrets."""
        if self.forest is None:
            return rows.withColumn("score", F.lit(self.constant))
        made = VectorAssembler(inputCols=_FEATURES, outputCol="vector").transform(rows)
        return self.forest.transform(made).withColumn("score", vector_to_array("probability")[1])


def fit(labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> Scanner:
    """Train the forest on featured findings with a ``label`` of 0 or 1, about ``sample`` of each at most.

    Rows of the held-out fold of ``doc_id`` are not used. Without rows of both labels nothing is trained.
    """
    rows = labelled.filter("label IN (0, 1)").filter(~held_out("doc_id"))
    counts = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return Scanner(None, float(max(counts, default=0)))
    often = [F.when(F.col("label") == k, sample / n) for k, n in counts.items() if n > sample]
    share = F.pmod(F.xxhash64("doc_id", "number", F.lit(13)), F.lit(1 << 30)) / (1 << 30)
    chosen = written(rows.filter(share < F.coalesce(*often, F.lit(2.0))).select("label", *_FEATURES), "labelled")
    made = VectorAssembler(inputCols=_FEATURES, outputCol="vector").transform(chosen)
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", numTrees=trees, maxDepth=depth, seed=17, maxMemoryInMB=64
    )
    return Scanner(forest.fit(made), 0.0)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate with ``score`` and ``secret`` (score of at least 0.5), scored by a forest.

    ``labelled``: findings of other texts, as ``findings`` gives them, with a ``label`` of 0 or 1; without
    them those findings of these documents are learned from whose form tells (``labelled_by_form``). The
    dictionary is counted over all documents. No row is dropped or capped; a string that recurs any
    number of times is looked at once.
    """
    words = dictionary(docs, text)
    found = written(features(findings(docs, doc_id, text, path), words), "featured")
    known = features(labelled, words) if labelled is not None else labelled_by_form(found)
    scored = fit(known).score(found)
    return scored.select(
        "row", "number", "doc_id", "digest", "path", "start", "length", F.sha2("candidate", 256).alias("fingerprint"), "score",
        (F.col("score") >= 0.5).alias("secret"),
    )


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", mask: str = MASK) -> DataFrame:
    """All documents, each secret in a text replaced by ``mask``; other columns and rows as they are.

    Documents without candidates are passed through; only those with some are joined with what was found.
    """
    marked, paths, hits = (fresh(docs, n) for n in ("digest", "scan_path", "secrets"))
    found = scan(docs, doc_id, text, path).filter("secret")
    found = found.groupBy(F.col("digest").alias(marked), F.coalesce("path", F.lit("")).alias(paths)).agg(
        F.collect_set("number").alias(hits))
    body = column(text).cast("string")
    has = F.coalesce(body.rlike(CANDIDATE), F.lit(False))
    with_some = docs.filter(has).withColumn(marked, F.sha2(body, 256)).withColumn(paths, F.coalesce(column(path).cast("string"), F.lit("")))
    pieces, strings = F.split(body, CANDIDATE, -1), F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0))
    pairs = F.arrays_zip(F.slice(pieces, 1, F.size(strings)).alias("gap"), strings.alias("string"))
    parts = F.transform(pairs, lambda p, i: F.concat(
        p["gap"], F.when(F.array_contains(F.col(hits), i), F.lit(mask)).otherwise(p["string"])))
    clean = F.concat(F.array_join(parts, ""), F.element_at(pieces, -1))
    joined = with_some.join(found, [marked, paths], "left").withColumn(text, F.when(F.col(hits).isNotNull(), clean).otherwise(body))
    return docs.filter(~has).unionByName(joined.select(*[column(c) for c in docs.columns]))
