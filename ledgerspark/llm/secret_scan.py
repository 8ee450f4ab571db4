"""Secret scans: candidates by pattern, false positives removed by a random forest.

A wide pattern finds strings that could be credentials. Each candidate is described by its length,
character transitions, dictionary coverage, path signs and neighbouring words, and a forest trained
from labelled findings decides. Scanning, features and scoring are DataFrame expressions and
Spark's own forest: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline as Steps
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.sampling import least_hashed
from ledgerspark.session import stored

_RUN = "A-Za-z0-9+/_-"
#: A private key block; a run of 16 or more key characters with a digit; or 8 or more characters after = or :.
CANDIDATE = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]*PRIVATE KEY-----)?"
    rf"|(?<![{_RUN}])(?=[A-Za-z+/_-]*+[0-9])[{_RUN}]{{16,}}+={{0,2}}"
    r"|(?<=[=:][ ]?[\"']?)[^\s\"'<>,;=:(){}\[\]|/]{8,}+"
)
#: Characters of the neighbourhood that are looked at before and after a candidate.
BEFORE, AFTER = 48, 24
THRESHOLD = 0.5
MASK = "[SECRET]"

# Common word list of code, configuration and placeholders, for the coverage feature.
DICTIONARY = (
    "access account address admin alpha application backup branch build bundle button cache change character class client "
    "cloud code color column command common component config connection container content control country current customer "
    "data database debug default delete deploy detail device directory document domain download dummy editor element email "
    "endpoint engine error event example export external feature file filter folder format frame function gateway global "
    "group handler header height history hosted house html https image import index input install instance integration "
    "internal invalid item java kernel language launch layer layout library license list local location login manager "
    "master memory message method metrics mobile model module monday monitor month move music name native network node "
    "number object office online option order output package page parent parser password patch path payload people person "
    "picture placeholder platform player plugin point policy port position price print private process product profile "
    "program project property provider public python query question random reader record region release remote report "
    "request resource response result sample schema screen script search secret section security select sequence server "
    "service session setting share shell simple site size software source staging standard start static status storage "
    "store stream string style subject summer summary support switch symbol system table target team template test text "
    "theme thread time title token tool total track train transaction type under unit update upload upper user utility "
    "value vendor version video view virtual volume watch website week weight width window winter word worker world writer your"
).split()
# Frequent letter pairs of prose.
_PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic"
_SENSITIVE = r"(?i)(?:token|secret|passw|pwd|api[_-]?key|access[_-]?key|private|credential|auth|bearer|client[_-]?id)"
_BENIGN = (
    r"(?i)(?:commit|sha-?\d|sha\b|md5|checksum|digest|hash|uuid|guid|revision|version|build|example|dummy|sample|integrity"
    r"|etag|sequence|invoice|order|model|serial|img|image|src|href)"
)
_PREFIX = r"^(?:AKIA|ASIA|gh[pousr]_|glpat-|xox[abprs]-|sk_live_|rk_live_|sk-|AIza|ya29|eyJ|-----BEGIN)"

FEATURES = (
    "length transitions runs_longest digits uppers distinct hex_only pairs dictionary slashes in_path extension url "
    "assigned quoted sensitive benign prefixed symbols"
).split()


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate: key, start (characters before it), candidate, before and after.

    Texts without a candidate, null and empty ones among them, end at the first filter.
    """
    hit = docs.select(key, F.col(text).alias("_text")).filter(F.col("_text").rlike(CANDIDATE))
    cut = hit.select(
        key, F.split("_text", CANDIDATE).alias("_between"), F.regexp_extract_all("_text", F.lit(CANDIDATE), F.lit(0)).alias("_found")
    )
    # where each piece between ends up: running sum of what came before
    lengths = F.transform("_found", lambda c, i: F.length(F.get("_between", i)) + F.length(c))
    starts = F.aggregate(
        lengths,
        F.array(F.lit(0)),
        lambda acc, n: F.concat(acc, F.array(F.try_element_at(acc, F.lit(-1)) + n)),
    )
    each = cut.withColumn("_starts", starts).select(key, "_between", "_starts", F.posexplode("_found").alias("_i", "candidate"))
    before, after = F.get("_between", F.col("_i")), F.get("_between", F.col("_i") + 1)
    return each.select(
        key,
        (F.get("_starts", F.col("_i")) + F.length(before)).cast("bigint").alias("start"),
        "candidate",
        F.right(before, F.lit(BEFORE)).alias("before"),
        F.left(after, F.lit(AFTER)).alias("after"),
    )


def with_features(found: DataFrame) -> DataFrame:
    """``found`` (candidate, before, after) plus one double per name in ``FEATURES``."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    n = F.greatest(F.length(c), F.lit(1))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    runs = F.regexp_replace(classes, r"(.)\1+", "$1")
    longest = F.array_max(F.transform(F.regexp_extract_all(classes, F.lit(r"(.)\1*"), F.lit(0)), lambda r: F.length(r)))
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    low = F.lower(c)

    def share(pattern: str, of: Column = c) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / n

    flags = {
        "hex_only": c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "in_path": before.rlike(r"[./\\~]$") | c.startswith("/"),
        "extension": after.rlike(r"^\.[A-Za-z]{1,4}\b"),
        "url": before.rlike(r"://\S*$"),
        "assigned": before.rlike(r"(?:[=:]|=>)\s*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
        "sensitive": before.rlike(_SENSITIVE),
        "benign": before.rlike(_BENIGN),
        "prefixed": c.rlike(_PREFIX),
    }
    numbers = {
        "length": n,
        "transitions": (F.length(runs) - 1) / n,
        "runs_longest": longest,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / F.least(n, F.lit(40)),
        "pairs": share(_PAIRS, low),
        "dictionary": 1 - F.length(F.regexp_replace(low, words, "")) / n,
        "slashes": share("/"),
        "symbols": share("[^A-Za-z0-9]"),
    }
    all_of = {**numbers, **{name: flag.cast("int") for name, flag in flags.items()}}
    return found.withColumns({f: F.coalesce(all_of[f].cast("double"), F.lit(0.0)) for f in FEATURES})


def labelled_findings(spark: SparkSession, prose: list[str], rows: int = 4800, seed: str = "findings") -> DataFrame:
    """Reviewed-style findings (candidate, before, after, label) made from rules: credentials in the places
    where they leak (label 1), and look-alikes such as checksums, ids, paths and placeholders (label 0).

    ``prose`` gives the neighbouring words. Bounded by ``rows``; the same for the same arguments.
    """
    i = F.col("id")

    def digest(salt: str) -> Column:
        return F.sha2(F.concat(F.lit(f"{seed}-{salt}-"), i.cast("string")), 256)

    def pick(options: list[str], salt: str) -> Column:
        # one literal, as thousands of them are what the driver's memory goes to
        return F.get(F.split(F.lit("\n".join(options)), "\n"), F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(options))).cast("int"))

    def base64(n: int, salt: str = "b") -> Column:
        return F.substring(F.base64(F.unhex(F.concat(digest(salt), digest(salt + "2")))), 1, n)

    def plain(n: int, salt: str = "p") -> Column:
        return F.substring(F.translate(F.concat(base64(80, salt), base64(80, salt + "x")), "+/=", ""), 1, n)

    def words(count: int, sep: str, salt: str) -> Column:
        return F.concat_ws(sep, *[pick(DICTIONARY, f"{salt}{k}") for k in range(count)])

    name = pick(["token", "secret", "password", "api_key", "apikey", "access_key", "auth_token", "client_secret", "SECRET_KEY", "TOKEN"], "name")
    sign = pick([' = "', '="', ": '", "=", ": ", ' := "'], "sign")
    close = F.when(sign.endswith('"'), '"').when(sign.endswith("'"), "'").otherwise("")
    said = F.concat(F.lit(" "), pick(prose or ["the"], "w1"), F.lit(" "), pick(prose or ["the"], "w2"), F.lit(" "))
    then = F.concat(F.lit(" "), pick(prose or ["the"], "w3"), F.lit(" "))
    told = F.concat(said, name, sign)
    sha1 = F.substring(digest("h"), 1, 40)
    uuid = F.concat_ws("-", *[F.substring(digest("u"), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    hashed = F.concat(said, pick(["commit ", "sha1: ", "sha256=", "md5 ", "checksum: ", 'integrity="', "revision ", "etag: "], "hn"))
    length = F.substring(F.concat(digest("l"), digest("m")), F.lit(1), F.element_at(F.lit([32, 40, 48, 64]), (F.pmod(F.xxhash64(i), F.lit(4)) + 1).cast("int")))
    ids = F.concat(said, pick(["uuid ", "id=", "order ", "invoice: ", "serial ", "guid: ", "model "], "in"))
    dummy = pick(["your_api_key_here_123", "xxxxxxxxxxxxxxxx0000", "changeme12345678", "example-token-00000000", "0000000000000000", "1234567890123456", "placeholder_value_1"], "ph")
    kinds: list[tuple[Column, Column, Column, int]] = [
        (length, told, F.concat(close, then), 1),
        (F.upper(sha1), F.concat(said, F.upper(name), sign), F.concat(close, then), 1),
        (base64(44), told, F.concat(close, then), 1),
        (plain(32), told, F.concat(close, then), 1),
        (F.concat(F.lit("AKIA"), F.upper(plain(16))), F.concat(said, sign), close, 1),
        (F.concat(F.lit("ghp_"), plain(36)), said, then, 1),
        (F.concat(F.lit("sk_live_"), plain(24)), told, F.concat(close, then), 1),
        (F.concat(plain(9), pick(["!", "#", "@", "%"], "pw"), plain(4, "q")), told, F.concat(close, then), 1),
        (length, hashed, then, 0),
        (uuid, ids, then, 0),
        (F.concat(F.lit("/"), words(3, "/", "pa"), F.lit("1")), F.concat(said, F.lit(".")), F.lit(".py "), 0),
        (words(3, "_", "sn"), F.concat(said, pick(["", "= ", "name: "], "s2")), F.lit("1 "), 0),
        (F.concat(words(3, "-", "ke"), pick(["2", "3", "2024"], "ks")), F.concat(said, F.lit("https://example.com/")), F.lit("/ "), 0),
        (dummy, told, F.concat(close, then), 0),
        (F.concat(pick(prose or ["the"], "n1"), pick(prose or ["the"], "n2"), pick(prose or ["the"], "n3"), F.lit("1")), said, then, 0),
        (F.concat(pick(prose or ["the"], "n4"), pick(prose or ["the"], "n5")), F.concat(said, pick(prose or ["the"], "n6"), F.lit(": ")), then, 0),
    ]
    made = F.array(
        *[
            F.struct(c.alias("candidate"), F.right(b, F.lit(BEFORE)).alias("before"), F.left(a, F.lit(AFTER)).alias("after"), F.lit(y).cast("double").alias("label"))
            for c, b, a, y in kinds
        ]
    )
    each = spark.range(0, -(-rows // len(kinds)), 1, 1).select(F.inline(made))
    return each.filter("length(candidate) >= 8")


def prose_words(docs: DataFrame, text: str = "text", texts: int = 32, words: int = 400) -> list[str]:
    """Words of a bounded sample of texts, for the neighbourhoods of labelled findings: at most ``words``
    of the ``texts`` texts that come first by hash."""
    hashed = docs.select(F.coalesce(text, F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    some = least_hashed(hashed, "h", docs.count(), texts, "t")
    each = some.select(F.explode(F.split("t", r"[^\p{L}]+")).alias("w")).filter("length(w) BETWEEN 2 AND 14")
    return [r.w for r in each.groupBy("w").count().orderBy(F.desc("count"), "w").limit(words).collect()]


def train(findings: DataFrame, trees: int = 40, depth: int = 9, seed: int = 11) -> PipelineModel:
    """Random forest over ``FEATURES`` of labelled findings (candidate, before, after, label).

    Rows in one partition and in a fixed order give the same forest every time; the sample is bounded.
    """
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="_features", probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_class",
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt",
    )
    # written once: the forest reads them again and again, and each time the driver would plan all features
    rows = stored(with_features(findings.select("candidate", "before", "after", "label")), "findings")
    return Steps(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="_features"), forest]).fit(rows)


def scan(docs: DataFrame, model: PipelineModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate of every whole text: key, start, candidate, probability and is_secret.

    Null and empty texts have no candidates and an empty table gives no rows; null keys stay; a row
    that is repeated is scanned again. Only ``key`` and ``text`` are read, so other columns may have any name.
    """
    scored = model.transform(with_features(candidates(docs, key, text)))
    p = F.get(vector_to_array("_p"), 1)
    return scored.select(key, "start", "candidate", p.alias("probability"), (p >= THRESHOLD).alias("is_secret"))


def fitted(docs: DataFrame, text: str = "text") -> PipelineModel:
    """The forest for a corpus: trained from labelled findings whose neighbouring words are the corpus's."""
    return train(labelled_findings(docs.sparkSession, prose_words(docs, text)))


def masked(docs: DataFrame, model: PipelineModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every confirmed secret replaced by a mask; rows and other columns stay as they are.

    Secrets meet their text again by key and text hash, so rows that share a key are told apart.
    """
    named = docs.select(key, text).withColumn("_hash", F.xxhash64(text))
    at = named.select(F.struct(F.col(key).alias("k"), F.col("_hash").alias("h")).alias("_row"), F.col(text).alias("_body"))
    secrets = (
        scan(at, model, "_row", "_body")
        .filter("is_secret")
        .groupBy(F.col("_row.k").alias("_key"), F.col("_row.h").alias("_of"))
        # longest first, so that none is cut by one that it contains
        .agg(F.sort_array(F.collect_set(F.struct(F.length("candidate").alias("n"), F.col("candidate").alias("c"))), False).alias("_secrets"))
    )
    secrets = secrets.select(F.struct("_key", "_of", "_secrets").alias("s"))
    found = secrets["s"]
    body = F.aggregate(found["_secrets"], docs[text], lambda t, s: F.replace(t, s["c"], F.lit(MASK)))
    met = docs.join(secrets, docs[key].eqNullSafe(found["_key"]) & (F.xxhash64(docs[text]) == found["_of"]), "left")
    return met.select(*[F.when(found.isNull(), docs[c]).otherwise(body).alias(c) if c == text else docs[c] for c in docs.columns])
