"""Secret scans judged by corpus-wide ownership frequency.

Texts are scanned once for candidates. The hashes of their values are counted over the corpus
by distinct repositories and owners: a value of many owners is a copied example, a value that
stays with its owner and looks random is taken as live.
"""

import hashlib
import re
from collections.abc import Iterable
from math import log2

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import mapped, written

# The patterns of the base kinds and their least lengths, in the order of the output.
KINDS = ["assign", "access", "hex", "opaque"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run that is long enough is found whole, as with + and a test behind it
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
# The kind that the method adds: opaque tokens outside the base spans.
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Texts without any of these need no look at their characters.
HINTS = ["(?i)password|passwd|secret|token|api_?key", "AKIA", "[0-9a-f]{24}", "[A-Za-z0-9+/_=-]{20}"]
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your[_-]|(.)\1{5}", re.I)


def entropy(value: str) -> float:
    """Bits per character of the value's own character frequencies."""
    n = len(value)
    return -sum(c / n * log2(c / n) for c in (value.count(x) for x in set(value)))


def looks_live(value: str, least_entropy: float) -> bool:
    return entropy(value) >= least_entropy and not PLACEHOLDER.search(value)


def candidates(text: str, least_entropy: float) -> list[tuple[int, int, int, str]]:
    """Kind, start, end (code points) and value of each candidate."""
    found = [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = merged((s, e) for _, s, e, _ in found)
    at = 0
    for m in OPAQUE.finditer(text):
        while at < len(base) and base[at][1] <= m.start():
            at += 1
        if at < len(base) and base[at][0] < m.end():
            continue
        digits = sum(c.isdigit() for c in m[0])
        if digits >= 3 and len(m[0]) - digits >= 3 and looks_live(m[0], least_entropy):
            found.append((3, m.start(), m.end(), m[0]))
    return found


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same ground as disjoint spans in order."""
    result: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if result and s <= result[-1][1]:
            result[-1] = (result[-1][0], max(e, result[-1][1]))
        else:
            result.append((s, e))
    return result


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


SCANNED = (
    "doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, "
    "found array<struct<kind:int,start:int,end:int,hash:string,live:boolean>>"
)


def scan(part: pa.RecordBatch, least_entropy: float) -> dict:
    texts = pc.fill_null(part.column(3), "")
    hinted = pc.match_substring_regex(texts, HINTS[0])
    for hint in HINTS[1:]:
        hinted = pc.or_(hinted, pc.match_substring_regex(texts, hint))
    empty = hashlib.sha256(b"").hexdigest()
    n = [[0] * len(texts) for _ in range(3)]
    digest, found = [empty] * len(texts), [[] for _ in range(len(texts))]
    for i, any_hint in enumerate(hinted.to_pylist()):
        if not any_hint:
            continue
        own = candidates(texts[i].as_py(), least_entropy)
        base = [(s, k, e) for k, s, e, _ in own if k < 3]
        for _, k, _ in base:
            n[k][i] += 1
        digest[i] = hashlib.sha256(spans_text(base).encode()).hexdigest()
        found[i] = [
            {"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).hexdigest()[:32], "live": looks_live(v, least_entropy)}
            for k, s, e, v in own
        ]
    columns = dict(zip(["doc_id", "owner", "repository"], part.columns))
    return columns | {"n_assign": n[0], "n_access": n[1], "n_hex": n[2], "base_sha256": digest, "found": found}


def secrets(
    docs: DataFrame,
    owner: str = "source",
    repository: tuple[str, ...] = ("source", "lang"),
    copied_owners: int = 3,
    least_entropy: float = 3.0,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: `doc_id`, `n_assign`, `n_access`, `n_hex`, `base_sha256`, `spans`, `n_live`, `n_copied`, `most_repositories`.

    Base candidates (assign, access, hex) always stay. A value seen with `copied_owners` or more
    distinct owners is a copied example (`n_copied`). Other values of at least `least_entropy`
    bits a character that are no placeholders look live (`n_live`); of these, opaque tokens
    outside the base spans are added to `spans`. `most_repositories` is the largest number of
    distinct repositories (an owner and the values of `repository`) that one of the row's values
    was seen in, 0 without values. Spans are kind:start:end in code points, end exclusive, by
    start and then kind.

    Null and empty texts have no spans; a null owner or repository counts as one of its own.
    Repeated rows count once for ownership, each has its result. Values are kept as hashes only.
    Further columns are left out; an empty table gives an empty one.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.concat_ws(":", F.col(owner).isNull().cast("string"), F.col(owner).cast("string")).alias("owner"),
        F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(repository)])).alias("repository"),
        F.col(text).alias("text"),
    )
    scanned = mapped(rows, SCANNED, "text", lambda part: scan(part, least_entropy))
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()))
    seen = scanned.where(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("c"))
    seen = seen.select("row", "owner", "repository", "c.*")
    by_owner = seen.select("hash", "owner", "repository").distinct().groupBy("hash", "owner").agg(F.count("*").alias("n"))
    # Written, so that the join deals both sides anew and Spark can split a hot value.
    spread = written(by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("n").alias("repositories")))
    judged = seen.join(spread, "hash").withColumn("copied", F.col("owners") >= copied_owners)
    stays = (F.col("kind") < 3) | ~F.col("copied")
    kinds = F.array(*[F.lit(k) for k in KINDS])
    span = F.struct("start", "kind", "end")
    per_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(stays, span))).alias("own"),
        F.count_if(F.col("copied")).alias("n_copied"),
        F.count_if(~F.col("copied") & F.col("live")).alias("n_live"),
        F.max("repositories").alias("most_repositories"),
    )
    shown = F.transform("own", lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]))
    result = scanned.drop("found", "owner", "repository").join(per_row, "row", "left")
    return result.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(F.array_join(shown, ","), F.lit("")).alias("spans"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_live", "n_copied", "most_repositories")],
    )
