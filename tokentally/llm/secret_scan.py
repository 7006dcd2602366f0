"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame functions only: one regular expression marks the candidates of a whole text
in a single pass, the text is split at the marks, built-in functions measure each candidate, and
Spark's own random forest decides. The measures are length, character transitions, variety of
characters, dictionary coverage, the path (the row's ``source``) and the neighbouring words.

The forest is trained from labelled findings: those that the caller has (``labelled``), or else
those that a rule labels (``rule_label``): known key formats and clear assignments to a secret's
name, and clear numbers, placeholders and identifiers in prose; the rest, strong-looking
bare runs among it, stays unlabelled and the forest decides it.
"""

from __future__ import annotations

import hashlib
import string

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokentally.llm.common import every_column, free_name, settle

#: Bounds of the training sample; forest size; score from which a candidate is a secret.
SAMPLE_FINDINGS, TREES, DEPTH, SECRET_FROM = 20_000, 20, 6, 0.5

# Names of secrets, key formats, placeholder words, and common words for dictionary coverage.
NAMES = (
    "token|secret([_ -]?key)?|passw(or)?d|passwd|pwd|api[_ -]?key|access[_ -]?key|auth|bearer|credential|private[_ -]?key"
)
PREFIXED = (
    r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{20,}+|github_pat_[A-Za-z0-9_]{20,}+|"
    r"glpat-[A-Za-z0-9_-]{20,}+|xox[abeoprs]-[A-Za-z0-9-]{10,}+|[sr]k_(?:live|test)_[A-Za-z0-9]{16,}+|"
    r"AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36}"
)
_PART = "A-Za-z0-9+/_=-"
_BARE = r"[^\s\"'`,;<>(){}]"
_NAMED = rf"(?i:{NAMES})[\"']?[ \t]{{0,8}}[=:]"
#: In this order: the body of a PEM private key (1: what stands before it, 2: the body with its header lines);
#: the password of a URL (3: before, 4: password); in group 5 a value after the name of a secret, without quotes,
#: of 8 or more; a known key format; a run of 16 or more with a digit in it (that holds no such assignment);
#: a quoted value of 8 or more after an assignment. The first tests of an alternative are cheap ones that rule out
#: nearly all places. Repetitions are possessive or count a class, so a long run takes its length.
CANDIDATE = "|".join(
    [
        r"(-----BEGIN (?:[A-Z0-9]++ ){0,3}PRIVATE KEY-----)((?:\s{1,4}[A-Za-z]++-[A-Za-z]++: [^\n]*+){0,8}[A-Za-z0-9+/=\s]{16,}+)",
        r"(://[^\s/:@\"']*+:)([^\s/@\"']{5,}+)(?=@)",
        "((?<![A-Za-z0-9])(?:"
        + "|".join(
            [
                rf"(?<=[=: \t])(?<![^=: \t][ \t])(?<=[=:][ \t]{{0,8}})(?<={_NAMED}[ \t]{{0,8}})(?!//){_BARE}{{8,}}+",
                rf"(?<!_)(?=A[IKS]|g[hil]|xox|[rs]k_|npm)(?:{PREFIXED})",
                rf"(?<![{_PART}])(?=[{_PART}]{{16}})(?=[A-Za-z+/_=-]*+[0-9])(?!KEY-----)"
                rf"(?![A-Za-z0-9_-]{{0,64}}?{_NAMED}{_BARE}{{8}})[{_PART}]{{16,}}+",
                r"(?<=[\"'])(?<=[=:][ \t]{0,8}[\"'])[^\"'\s]{8,}+",
            ]
        )
        + "))",
    ]
)
#: Characters that no text should hold (Unicode noncharacters): the first that a text lacks marks its candidates.
MARKS = ("﷐", "﷑", "﷒", "﷓")


def _made(alphabet: str, n: int, salt: str) -> str:
    """``n`` characters of ``alphabet`` that look random and are always the same."""
    return "".join(alphabet[b % len(alphabet)] for i in range(1 + n // 32) for b in hashlib.sha256(f"{salt}{i}".encode()).digest())[:n]


_ANY = string.ascii_letters + string.digits
#: Known formats are rarer than a sample can show, so the forest also learns from findings made of them: prefix and
#: length of what follows, drawn with several salts. Beside a placeholder word they are none.
_FORMATS = [("AKIA", 16), ("ASIA", 16), ("ghp_", 36), ("gho_", 36), ("github_pat_", 60), ("glpat-", 20), ("xoxb-", 40)]
_FORMATS += [("sk_live_", 24), ("rk_test_", 24), ("AIza", 35), ("npm_", 36)]


def made_findings() -> list[tuple[str, str, str, float]]:
    """``(value, before, after, label)`` of known formats, keys in PEM, passwords in URLs, and placeholders of these."""
    out = []
    for salt in "abcd":
        for prefix, n in _FORMATS:
            value = prefix + _made(string.ascii_uppercase + string.digits if prefix in ("AKIA", "ASIA") else _ANY, n, prefix + salt)
            out += [(value, "we use ", " for it", 1.0), (value, "for example ", " here", 0.0)]
        out.append(("\n" + _made(_ANY, 90 + ord(salt), salt) + "==\n", "-----BEGIN RSA PRIVATE KEY-----", "-----END", 1.0))
        for n in (6, 9, 14):
            out.append((_made(_ANY, n, salt), "see postgres://deploy:", "@db.internal/x", 1.0))
    return out


PLACEHOLDERS = "example|sample|dummy|placeholder|changeme|your[_ -]|xxxx|redacted|fake|test"
DICTIONARY = (
    "the|and|for|that|with|this|from|have|not|are|was|you|your|all|can|will|one|out|about|which|their|there|when|"
    "what|more|been|other|into|time|than|only|over|such|also|after|first|where|most|should|because|each|before|between|"
    "key|user|name|file|data|test|code|value|string|number|order|page|item|list|type|class|index|version|content|image|"
    "secret|password|token|account|server|client|request|response|message|error|result|session|config|default|public|"
    "private|static|return|function|method|object|array|table|column|field|query|update|create|delete|insert|select|"
    "module|package|import|export|build|debug|release|master|branch|commit|merge|local|remote|global|system|"
    "service|handler|manager|factory|builder|provider|controller|component|template|document|report|"
    "address|street|city|country|phone|email|product|customer|supplier|invoice|payment|price|amount|total|count|size|"
    "length|width|height|color|style|border|margin|button|window|screen|layout|event|action|state|status|level|group|"
    "admin|login|logout|access|auth|role|permission|policy|region|bucket|volume|network|host|port|path|route"
)
PATHS = "test|example|sample|fixture|mock|docs?/"

FEATURES = (
    "length",
    "transitions",
    "variety",
    "digit_share",
    "is_hex",
    "is_number",
    "covered",
    "path_test",
    "named",
    "assigned",
    "quoted",
    "placeholder",
    "known",
)


def find_candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """``[doc_id, path, content, start, value, before, after]``, a row for each candidate in a whole text.

    ``start`` counts code points from 0; ``before`` and ``after`` are the 40 and 20
    characters beside it, as far as the next candidate; ``content`` is the MD5 of the text. In a text that
    holds all of ``MARKS`` the first of them is read as U+FFFD.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    mark = F.lit(None).cast("string")
    for m in reversed(MARKS):
        mark = F.when(~F.contains(text, F.lit(m)), F.lit(m)).otherwise(mark)
    plain = F.when(mark.isNull(), F.translate(text, MARKS[0], "\ufffd")).otherwise(text)  # it holds every mark
    rows = docs.select(
        "doc_id",
        F.col(path).cast("string").alias("path"),
        F.md5(text.cast("binary")).alias("content"),
        F.monotonically_increasing_id().alias("row"),
        plain.alias("text"),
        F.coalesce(mark, F.lit(MARKS[0])).alias("mark"),
    )
    marked = F.regexp_replace("text", F.lit(CANDIDATE), F.concat(F.lit("$1$3"), "mark", F.lit("$2$4$5"), "mark"))
    rows = rows.select("doc_id", "path", "content", "row", F.split(marked, F.col("mark"), -1).alias("ps"))  # gap, value, gap, ...
    cut = (
        "if(size(ps) > 1, transform(sequence(1, size(ps) - 2, 2), i -> named_struct('gap', length(ps[i - 1]), 'value', ps[i], "
        "'before', right(ps[i - 1], 40), 'after', left(ps[i + 1], 20))), null)"
    )
    rows = rows.select("doc_id", "path", "content", "row", F.posexplode(F.expr(cut)).alias("place", "c"))
    rows = rows.select("doc_id", "path", "content", "row", "place", "c.*")
    earlier = Window.partitionBy("row").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # candidates of one text
    done = F.coalesce(F.sum(F.col("gap") + F.length("value").cast("bigint")).over(earlier), F.lit(0))
    return rows.withColumn("start", done + F.col("gap")).select("doc_id", "path", "content", "start", "value", "before", "after")


def measured(found: DataFrame) -> DataFrame:
    """``found`` with the features of each candidate as doubles."""
    value, low = F.col("value"), F.lower(F.col("value"))
    runs = value
    for kind, mark in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[^A-Za-z0-9]+", "-")):
        runs = F.regexp_replace(runs, kind, mark)
    length = F.length(value).cast("double")
    beside = F.lower(F.concat_ws(" ", "before", "after"))
    features: dict[str, Column] = {
        "length": length,
        "transitions": F.length(runs) - 1,
        "variety": F.size(F.array_distinct(F.split(value, ""))) / length,
        "digit_share": F.length(F.regexp_replace(value, "[^0-9]+", "")) / length,
        "is_hex": value.rlike("^[0-9a-fA-F]+$"),
        "is_number": value.rlike("^[0-9_-]+$"),
        "covered": 1 - F.length(F.regexp_replace(low, DICTIONARY, "")) / length,
        "path_test": F.coalesce(F.lower("path").rlike(PATHS), F.lit(False)),
        "named": F.lower("before").rlike(rf"({NAMES})[\"']?\s*[=:]?\s*[\"']?$"),
        "assigned": F.col("before").rlike("[=:]\\s*[\"']?$"),
        "quoted": F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        # a word of its own, and not the host name that stands for any (mail@example.com)
        "placeholder": beside.rlike(rf"(?<![\w@.])(?:{PLACEHOLDERS})(?!\.(?:com|org|net|edu))") | low.rlike(PLACEHOLDERS),
        "known": value.rlike(rf"^(?:{PREFIXED})")
        | F.col("before").rlike("PRIVATE KEY-----$")
        | (F.col("before").rlike("(://|^[^\\s/:@\"']{39})[^\\s/:@\"']*:$|^[^\\s/:@\"']{39}:$") & F.col("after").startswith("@")),
    }
    return found.withColumns({k: v.cast("double") for k, v in features.items()})


def rule_label() -> Column:
    """1 a clear secret, 0 clearly none, null undecided: strong-looking runs that stand bare among them."""
    secret = "known = 1 or named = 1 and assigned = 1 and transitions >= 3 and covered < 0.5"
    strong = "transitions >= 6 and variety * length >= 12"  # twelve different characters
    bare = f"named = 0 and assigned = 0 and quoted = 0 and not ({strong})"
    other = f"placeholder = 1 or known = 0 and (is_number = 1 or covered >= 0.5 or {bare})"
    return F.expr(f"case when ({secret}) and placeholder = 0 then 1D when {other} then 0D end")


def train_forest(labelled: DataFrame, sample_findings: int = SAMPLE_FINDINGS):
    """A forest fitted to findings with their features and ``label`` 0 or 1; ``None`` unless both occur.

    The sample is the ``sample_findings`` of smallest hash of value and neighbourhood. ``made_findings``
    are added with a tenth of the sample's weight.
    """
    order = F.xxhash64("value", "before", "after").alias("order")
    known = labelled.where("label is not null").select("label", order, *FEATURES)  # numbers alone meet in one task
    known = settle(known.orderBy("order", "label", *FEATURES).limit(sample_findings).drop("order"), "labelled")
    if known.select("label").distinct().count() < 2:
        return None
    made = made_findings()
    weight = max(1.0, known.count() / 10 / len(made))
    rows = [F.struct(*[F.lit(v).alias(c) for c, v in zip(("value", "before", "after", "label"), m)]) for m in made]
    added = labelled.sparkSession.range(1).select(F.inline(F.array(*rows))).withColumn("path", F.lit(None).cast("string"))
    added = measured(added).select("label", *FEATURES, F.lit(weight).alias("weight"))
    known = known.withColumn("weight", F.lit(1.0)).unionByName(added)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(known)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=5, labelCol="label", featuresCol="features", weightCol="weight", featureSubsetStrategy="all"
    )
    # the copy leaves the training summary behind, which holds the session and would be sent with the model
    return forest.fit(rows.select("label", "features", "weight")).copy()


def scored(findings: DataFrame, forest) -> DataFrame:
    """``findings`` with ``score``: the forest's, or without one the rule's label (undecided: 0.5)."""
    if forest is None:
        return findings.withColumn("score", F.coalesce(rule_label(), F.lit(0.5)))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(findings)
    rows = forest.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return rows.select(*findings.columns, "score")


def scan_secrets(docs: DataFrame, *, path: str = "source", labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of ``docs [doc_id, text, source]`` with the forest's verdict.

    ``labelled [value, path, before, after, label]``, where given, are findings with label 1 or 0 to train
    from; else ``rule_label`` labels the candidates of ``docs``.

    ``[doc_id, path, content, start, value, score, secret]``. Rows without a
    candidate, null and empty texts among them, give no row. Repeated rows and null
    ids are carried along; a null path is no test path. Other columns are ignored; an empty table
    gives an empty result.
    """
    found = settle(measured(find_candidates(docs, path)), "findings")
    taught = found.withColumn("label", rule_label()) if labelled is None else measured(labelled)
    forest = train_forest(taught)
    rows = scored(found, forest).withColumn("secret", F.col("score") >= SECRET_FROM)
    return rows.select("doc_id", "path", "content", "start", "value", "score", "secret")


def hide_secrets(docs: DataFrame, *, path: str = "source", mark: str = "[SECRET]", size: str | None = "n_chars") -> DataFrame:
    """``docs`` with each secret's value replaced by ``mark`` wherever it stands in that text.

    All rows and columns stay; texts without a secret are untouched. ``size``, where
    such a column exists, is set to the new number of characters of changed texts. Rows are
    matched by path and content.
    """
    a, b, v = (free_name(docs.columns, n) for n in ("at_path", "content_md5", "secret_values"))
    bad = scan_secrets(docs, path=path).where("secret").groupBy(F.coalesce("path", F.lit("\0")).alias(a), F.col("content").alias(b))
    bad = settle(bad.agg(F.collect_set("value").alias(v)), "secrets")
    keyed = docs.withColumn(a, F.coalesce(F.col(path).cast("string"), F.lit("\0")))
    keyed = keyed.withColumn(b, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    joined = keyed.join(bad, [a, b], "left")
    longest_first = f"array_sort({v}, (x, y) -> length(y) - length(x))"
    hidden = F.expr(f"if({v} is null, text, aggregate({longest_first}, text, (t, s) -> replace(t, s, '{mark}')))")
    out = joined.withColumn("text", hidden)
    if size is not None and size in docs.columns:
        kind = docs.schema[size].dataType
        out = out.withColumn(size, F.when(F.col(v).isNull(), F.col(size)).otherwise(F.length("text")).cast(kind))
    return out.select(*every_column(docs))
