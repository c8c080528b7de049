"""Secrets in texts: candidates by a pattern, false positives removed by a random forest; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.llm.tables import saved

KEYWORD = r"(?i)(pass(word|wd|phrase)?|secret|token|api[_-]?key|access[_-]?key|auth|credential|bearer)"
#: A secret's name up to its end (passwords, DB_PASSWORD_2, secretKey, but not author or compass) and what assigns its value.
NAME = (
    r"(?:(?i:passw(?:or)?d|passphrase|secret|token|api[_-]?key|access[_-]?key|credential|bearer)|(?<![A-Za-z])(?i:pass|o?auth)|(?<=[a-z])(?:Pass|Auth))"
    r"(?:s|S|[0-9]{1,4}|[A-Z][a-z]{1,12})?" + "(?:[_.-][A-Za-z0-9]{1,12})?" * 2
)
ASSIGNED = NAME + r"[\\\"'`\])]{0,4}\s{0,16}(?::\s?[A-Za-z]{1,12}\s?)?[=:]{1,3}>?\s{0,16}"
#: Runs of 12 or more characters of keys and hashes with a digit among them, from their first character on.
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}"


def _quoted(q: str) -> str:
    """What ``q`` encloses, with escapes; where it has spaces, only if no run is in it (the runs are candidates then)."""
    plain, blank = rf"[^{q}\\\r\n]", rf"[^{q}\r\n]"
    return rf"(?<={q})(?=[^{q}\s]++{q}|(?!{blank}*?{RUN}){blank}){plain}*+(?:\\.{plain}*+){{0,200}}(?={q})(?<!{q})"


#: What is assigned to a secret's name, of any length and symbols: enclosed by quotes or by escaped ones, or up to a space or a separator.
VALUE = (
    r"(?<=[=:>\s\"'`])(?<=[=:]>?\s{0,16}\\?[\"'`]?)(?<=" + ASSIGNED + r"\\?[\"'`]?)(?!\w{2,12}://)(?!(?<=[=:])[=:])(?:"
    r"(?<=\\[\"'`])[^\"'`\\\r\n]++(?=\\[\"'`])|" + "|".join(rf"(?<!\\{q}){_quoted(q)}" for q in "\"'`") + r"|[^\s\"'`,;&<>]*[^\s\"'`,;&<>.:)\]}\\])"
)
CANDIDATE = f"(?:{VALUE}|{RUN})"
KNOWN = r"(?<![A-Za-z0-9+/_-])((AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})(?![A-Za-z0-9+/_-])"
#: Values that stand for one given elsewhere: constants, types, placeholders; unquoted, also calls and attributes.
REFERENCE = r"^((?i)none|null|nil|true|false|undefined|str|string|int|bool|boolean|\$\{.*\}|\{+[\w. ]+\}+|%[sd]|<[^>]*>|[*.xX]+)$"
CODE = r"^[A-Za-z_]\w*([.]\w+)*[(\[]|^[A-Za-z_]+([.][A-Za-z_]+)+$|^\$[A-Z_]+$"
BEFORE, AFTER, DICTIONARY = 40, 12, 1000
#: The forest is trained on at most so many findings of each label.
SAMPLE, TREES, DEPTH, SEED = 10_000, 25, 6, 3
FEATURES = ("length", "changes", "digits", "upper", "different", "hex", "coverage", "path", "assigned", "quoted", "named", "near_name")
MASK = "<SECRET>"


def share(found: Column, of: Column) -> Column:
    return found / F.greatest(of, F.lit(1))


def with_hits(documents: DataFrame) -> DataFrame:
    """The documents with candidates: all columns, ``_row``, and the text as ``_found`` and the ``_gaps`` around them."""
    parts = {"_found": F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)), "_gaps": F.split("text", CANDIDATE)}
    return documents.where(F.col("text").rlike(CANDIDATE)).withColumns({**parts, "_row": F.monotonically_increasing_id()})


def dictionary(hits: DataFrame, words: int = DICTIONARY) -> list[str]:
    """The three-letter pieces of the most frequent words in the texts with candidates. An action."""
    every = hits.select(F.explode(F.flatten(F.transform("_gaps", lambda g: F.regexp_extract_all(F.lower(g), F.lit("[a-z]{4,}"), F.lit(0))))).alias("word"))
    top = every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(words).collect()
    return sorted({r["word"][i : i + 3] for r in top for i in range(len(r["word"]) - 2)})


def candidates(hits: DataFrame, pieces: Sequence[str]) -> DataFrame:
    """One row per candidate: _row, number, start (characters before it), candidate and the features."""
    each = hits.select("_row", "_found", "_gaps", "text", F.posexplode("_found").alias("number", "candidate"))
    upto = F.aggregate(F.slice("_gaps", 1, F.col("number") + 1), F.lit(0), lambda n, g: n + F.length(g))
    upto = upto + F.aggregate(F.slice("_found", 1, F.col("number")), F.lit(0), lambda n, g: n + F.length(g))
    each = each.withColumn("start", upto)
    before = F.substring("text", F.greatest(F.col("start") - (BEFORE - 1), F.lit(1)), F.least("start", F.lit(BEFORE)))
    each = each.withColumns({"before": before, "after": F.substring("text", F.col("start") + F.length("candidate") + 1, F.lit(AFTER))})
    text, length = F.col("candidate"), F.length("candidate")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[0-9]", "\u0001"), "[A-Z]", "\u0002"), "[a-z]", "\u0003")
    # All characters beside the next two: cut once, where substrings at every place would each walk there.
    chars = F.split(F.lower(text), "")
    beside = F.arrays_zip(*[F.slice(chars, F.lit(k), F.size(chars)) for k in (1, 2, 3)])
    triples = F.transform(F.slice(beside, F.lit(1), F.greatest(length - 2, F.lit(1))), lambda t: F.concat_ws("", t["0"], t["1"], t["2"]))
    known = F.filter(triples, lambda t: t.isin(list(pieces))) if pieces else F.array()
    flag = lambda c: c.cast("double")
    features = {
        "length": length.cast("double"),
        "changes": share(F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1, length),
        "digits": share(F.length(F.regexp_replace(text, "[^0-9]", "")), length),
        "upper": share(F.length(F.regexp_replace(text, "[^A-Z]", "")), length),
        "different": share(F.size(F.array_distinct(F.split(text, ""))), length),
        "hex": flag(text.rlike("^[0-9a-f]+$")),
        "coverage": share(F.size(known), F.size(triples)),
        "path": flag((text.contains("/") & ~encoded()) | F.col("before").rlike(r"[/.@]$") | F.col("after").rlike(r"^[.@][a-z]")),
        "assigned": flag(F.col("before").rlike(r"[=:]>?\s*\\?[\"'`]?$")),
        "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike(r"^\\?[\"'`]")),
        "named": flag(F.col("before").rlike(KEYWORD + r"\W*$") | F.col("before").rlike(ASSIGNED + r"\\?[\"'`]?$")),
        "near_name": flag(F.col("before").rlike(KEYWORD)),
    }
    return each.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in features.items()}).drop("_found", "_gaps", "text")


def is_name() -> Column:
    """Whether a candidate is itself a secret's name that something is assigned to."""
    return (F.col("assigned") == 0) & F.col("candidate").rlike(NAME + "$") & F.col("after").rlike(r"^[\\\"'`\])]{0,4}\s*[=:]")


def encoded() -> Column:
    """Whether a candidate with slashes reads as base64, not as a path: no path's start, all three kinds of characters, as secrets have them."""
    text = F.col("candidate")
    return ~text.rlike(r"^[~.]{0,2}/|[.][A-Za-z]{1,5}$") & text.rlike("[0-9]") & text.rlike("[A-Z].*[A-Z]") & text.rlike("[a-z]") & F.col("before").rlike(ASSIGNED + r"\\?[\"'`]?$")


def weak_label() -> Column:
    """1 for a provider's key format or a value assigned to a secret's name, 0 for digits, paths or references only, else NULL."""
    text, digit = F.col("candidate"), F.col("digits") > 0
    given = text.rlike(REFERENCE) | ((F.col("quoted") == 0) & text.rlike(CODE))
    quoted = (F.col("quoted") == 1) & (digit | (F.col("coverage") <= 0.8))
    likely = quoted | (digit & ((F.col("digits") < 1) | (F.col("length") >= 12))) | (F.col("changes") > 0.3)
    assigned = (F.col("named") == 1) & (F.col("assigned") == 1)
    sure = text.rlike(KNOWN) | (assigned & (F.col("path") == 0) & (F.col("length") >= 6) & likely & ~given)
    never = (F.col("digits") == 1) | ((F.col("path") == 1) & (F.col("named") == 0)) | (F.col("coverage") > 0.8)
    return F.when(sure, 1.0).when(is_name() | (assigned & given) | (never & (F.col("near_name") == 0)), 0.0)


def judged(findings: DataFrame, labelled: DataFrame) -> DataFrame:
    """``findings`` and the forest's ``score`` (share of votes for a secret); trained on (features, label). Actions.

    Each label's findings are sampled by hash up to ``SAMPLE``. Without findings of both labels, or where no
    forest can be trained, the score is the weak label, 0 where that is NULL.
    """
    some = labelled.where("label IS NOT NULL").select(*FEATURES, "label", F.xxhash64("candidate", *FEATURES).alias("_at"))
    order = ["_at", *FEATURES]
    picked = some.where("label = 1").orderBy(*order).limit(SAMPLE).unionAll(some.where("label = 0").orderBy(*order).limit(SAMPLE))
    picked = saved(picked.repartitionByRange(1, "label", *order).sortWithinPartitions("label", *order), "secret-sample")
    if picked.select("label").distinct().count() < 2:
        return findings.withColumn("score", F.coalesce(weak_label(), F.lit(0.0)))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(assembled.transform(picked))
    forest.setProbabilityCol("_chance").setRawPredictionCol("").setPredictionCol("")
    scored = forest.transform(assembled.transform(findings))
    return scored.withColumn("score", vector_to_array("_chance")[1]).drop("_features", "_chance")


def findings(documents: DataFrame, fold: int = 5, labelled: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(hits, findings): documents with candidates, and every candidate with start, score and ``secret``. Actions.

    ``labelled`` are findings (features and label) to train on; by default those of the table itself that
    ``weak_label`` can tell, outside the fold of every ``fold``-th document by hash of its text. Candidates in known
    formats are secrets whatever the forest says, names that something is assigned to are none. NULL and empty texts have none; repeated rows are scanned each.
    """
    hits = saved(with_hits(documents), "secret-hits")
    every = saved(candidates(hits, dictionary(hits)), "secret-candidates")
    if labelled is None:
        train = F.pmod(F.xxhash64("before", "candidate"), F.lit(fold)) != 0
        labelled = every.where(train).withColumn("label", weak_label())
    scored = judged(every, labelled)
    secret = ((F.col("score") >= 0.5) & ~is_name()) | F.col("candidate").rlike(KNOWN)
    return hits, scored.withColumn("secret", secret)


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, number, start, length, crc32 (of the candidate), score and secret of every candidate. Actions."""
    hits, found = findings(documents.select("doc_id", "text"))
    named = found.join(hits.select("_row", "doc_id"), "_row")
    length = F.length("candidate").cast("long").alias("length")
    return named.select("doc_id", "number", F.col("start").cast("long").alias("start"), length, F.crc32("candidate").alias("crc32"), "score", "secret")


def redact(documents: DataFrame) -> DataFrame:
    """``documents``, all columns whatever their names, with every secret in ``text`` replaced by a mark. Actions."""
    columns = documents.columns
    apart = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("document"), "text")
    hits, found = findings(apart)
    verdicts = found.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "secret"))), lambda v: v.secret).alias("_secret"))
    masked = F.zip_with("_found", "_secret", lambda f, s: F.when(s, F.lit(MASK)).otherwise(f))
    rebuilt = F.array_join(F.zip_with("_gaps", masked, lambda g, f: F.concat(g, F.coalesce(f, F.lit("")))), "")
    changed = hits.join(verdicts, "_row").select(F.col("document").withField("text", rebuilt).alias("document")).select("document.*")
    return documents.where(~F.coalesce(F.col("text").rlike(CANDIDATE), F.lit(False))).unionByName(changed)
