"""Secret scan with corpus-wide ownership frequency.

Patterns propose candidate spans in every whole text. Each candidate's value is
hashed (of a private key the whole body, without line ends), and the hashes are
counted over the corpus by distinct repositories and owners: a value that several
owners hold, or two owners in many repositories, is a widely copied example; one
that stays with one owner (in however many repositories) or with two in few, and
looks random, is a live-looking credential.

Only DataFrame and SQL functions run on the data. Defined results: null text
counts as empty (no spans); a null owner or repository counts as one of its own;
copies and repeated ids each give their row; an empty table gives no rows; other
input columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_of

#: A line end in a key block, as it is or escaped (keys in JSON).
_EOL = "(?:\\s|\\\\+[nrt])"
#: What ends a header line: at least one of these, not just a blank.
_LINE_END = "(?:[\\r\\n]|\\\\+[nrt])"

#: Kinds in their fixed order: pattern, and the group that holds the value. Runs
#: are maximal, so a least length in the pattern drops the same matches as a
#: check after it; assign is checked after it (``MIN_ASSIGN``).
KINDS: dict[str, tuple[str, int]] = {
    "assign": ("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2),
    "access": ("AKIA[A-Z0-9]{16,}", 0),
    "hex": ("[0-9a-f]{24,}", 0),
    "provider": ("gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                 "|eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}", 0),
    # the whole block, with header lines, up to its END line; its value is the
    # body. Without an END line: the header and what follows it at once.
    "private_key": ("-----BEGIN ([A-Z ]{0,30})PRIVATE KEY-----"
                    f"(?:{_EOL}*+(?:[A-Za-z][A-Za-z0-9-]{{0,40}}:[^\\r\\n\\\\]{{0,200}}{_LINE_END}{_EOL}*+){{0,8}}+"
                    "((?:[A-Za-z0-9+/=\\s]++|\\\\+[nrt])*+)-----END \\1PRIVATE KEY-----"
                    "|\\s{0,4}[A-Za-z0-9+/=]{0,64})", 2),
}
BASE_KINDS = ("assign", "access", "hex")
MIN_ASSIGN = 6
#: Owners from which on a value counts as a widely copied example.
MIN_OWNERS = 3
#: Repositories from which on a value of two owners counts as one, too.
MIN_REPOSITORIES = 5
PLACEHOLDER = "(?i)example|sample|dummy|changeme|placeholder|your|xxxx|0{8}|1234567"
#: For key bodies, which are so long that four letters meet by chance.
KEY_PLACEHOLDER = PLACEHOLDER.replace("your|xxxx", "x{8}")


def _spans(kind_no: int, kind: str) -> Column:
    """Spans of one kind, in code points: texts between matches and the matches
    themselves, laid end to end, give the offsets."""
    pattern, group = KINDS[kind]
    text = F.col("text")
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    if kind == "private_key":  # the body without line ends, so that each form of a key has one hash
        bare = F.transform(value, lambda v: F.regexp_replace(v, _EOL, ""))
        value = F.zip_with(bare, whole, lambda b, w: F.when(b == "", w).otherwise(b))
    matched = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("match"),
                           value.alias("value"))
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,value:string>>")

    def step(acc, m):
        start = acc["at"] + F.length(m["gap"])
        end = start + F.length(m["match"])
        found = F.struct(start.alias("start"), F.lit(kind_no).alias("kind_no"), end.alias("end"),
                         m["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], found).alias("out"))

    placed = F.aggregate(matched, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])
    if kind == "assign":
        placed = F.filter(placed, lambda s: F.length(s["value"]) >= MIN_ASSIGN)
    return F.when(text.rlike(pattern), placed).otherwise(none)


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_candidates(df: DataFrame, owner: str, repository: str) -> DataFrame:
    """One row for each document: ``row`` (a number of its own), doc_id, owner,
    repository and its spans in order, values as SHA-256 and ``random``: long,
    of letters and digits, no placeholder."""
    parts = df.select("doc_id", F.expr(owner).cast("string").alias("owner"),
                      F.expr(repository).cast("string").alias("repository"), text_of().alias("text"))
    spans = F.array_sort(F.concat(*(_spans(k, kind) for k, kind in enumerate(KINDS))))
    key = list(KINDS).index("private_key")

    def placeholder(s):
        whole_key = (s["kind_no"] == key) & ~s["value"].startswith("-----BEGIN")
        return F.when(whole_key, s["value"].rlike(KEY_PLACEHOLDER)).otherwise(s["value"].rlike(PLACEHOLDER))

    looked = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"),
        F.sha2(s["value"], 256).alias("hash"),
        ((F.length(s["value"]) >= 16) & s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")
         & ~placeholder(s)).alias("random")))
    return parts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
                        looked.alias("spans"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) over all documents. Copies of a value
    within a repository, then within an owner, are folded before each shuffle."""
    return (candidates.select("owner", "repository", F.explode("spans.hash").alias("hash"))
            .distinct()
            .groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"))
            .groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"),
                                 F.sum("repositories").alias("n_repositories")))


def scan_documents(df: DataFrame, owner: str = "source", repository: str = "concat_ws('/', source, lang)",
                   min_owners: int = MIN_OWNERS, min_repositories: int = MIN_REPOSITORIES) -> DataFrame:
    """doc_id, ``spans`` (start, kind_no, end, n_owners, n_repositories,
    verdict: example, live or weak) in order. ``owner`` and ``repository`` are
    SQL expressions over the input."""
    staged, _ = stage(find_candidates(df, owner, repository))
    copied = ((F.col("n_owners") >= min_owners)
              | (F.col("n_owners") >= 2) & (F.col("n_repositories") >= min_repositories))
    found = (staged.filter("size(spans) > 0")
             .select("row", "doc_id", F.explode("spans").alias("s")).select("row", "doc_id", "s.*"))
    judged = found.join(ownership(staged), "hash").select("row", "doc_id", F.struct(
        "start", "kind_no", "end", "n_owners", "n_repositories",
        F.when(copied, "example").when(F.col("random"), "live").otherwise("weak").alias("verdict")).alias("s"))
    with_spans = (judged.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list("s")).alias("spans"))
                  .select("doc_id", "spans"))
    kind = with_spans.schema["spans"].dataType
    without = staged.filter("size(spans) = 0").select("doc_id", F.array().cast(kind).alias("spans"))
    return with_spans.unionByName(without)


def digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans; of all spans, their
    places, verdicts and numbers of owners and repositories."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind_no"] < len(BASE_KINDS))

    def count(k):
        return F.size(F.filter(spans, lambda s: s["kind_no"] == k)).cast("long")

    return scanned.select(
        "doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE_KINDS)),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["verdict"]), ",").alias("verdicts"),
        F.array_join(F.transform(spans, lambda s: s["n_owners"].cast("string")), ",").alias("owners"),
        F.array_join(F.transform(spans, lambda s: s["n_repositories"].cast("string")), ",").alias("repositories"),
        F.size(F.filter(spans, lambda s: s["verdict"] == "live")).cast("long").alias("n_live"))
