"""Secret scans judged by corpus-wide ownership frequency.

One pass over the texts finds candidates: base kinds by pattern, and further kinds (key blocks,
signed tokens, vendor-prefixed keys, long mixed strings).  The hash of each candidate's value is
counted over the whole corpus by distinct repositories and owners.  A value that many owners
hold is an example that was copied around; one that few hold and that looks random is live.
Base spans always stay; of the further kinds, those judged live are added where they overlap no
base span (a key block where its header does).  The value of a key block is its body.

Only candidates are shuffled: first reduced to one row for each (hash, repository, owner), so
that a value copied into a third of the corpus is counted on the map side; the verdicts are
joined back by hash, where a frequent hash is split by the skew join, and gathered for each text.

Defined results: a null or empty text has no spans; a null owner or repository is one of its
own; repeated rows get equal results; very long texts are scanned whole, in time in
proportion; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import whole_text
from ledgerline.session import materialize, ship_functions

ship_functions(__name__)

#: A value in the hands of so many owners is an example.
EXAMPLE_OWNERS = 4
#: Bits a character that a live value has at least.
LIVE_ENTROPY = 2.5

#: Base kinds with their patterns, then the further kinds.
BASE = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
FURTHER = (
    # From the header to the END line; without one, the header lines and base64 that follow.
    ("block", re.compile(
        r"(?P<header>-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)(?:"
        r"(?P<body>(?:[^-]++|-(?!----(?:BEGIN|END) ))*+)-----END [A-Z ]{0,40}PRIVATE KEY-----"
        r"|(?P<cut>\s*+(?:[A-Za-z-]++:\x20[^\n]*+\n)*+(?:[A-Za-z0-9+/=\s]|\\[nr])*+))")),
    ("signed", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")),
    ("vendor", re.compile(r"\b(?:gh[opsu]_[A-Za-z0-9]{30,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{30,}+)")),
    ("mixed", re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+={0,2}")),
)
KINDS = (*BASE, *(k for k, _ in FURTHER))
PLACEHOLDER = re.compile(r"(?i)example|changeme|placeholder|dummy|sample|your[_-]|x{6,}|\*{4,}|(.)\1{7,}")

LINE_ENDS, ZERO_BYTES = re.compile(r"\\[nr]|\s+"), re.compile("A{8,}")

Candidate = tuple[str, int, int, str]


def base_candidates(text: str) -> list[Candidate]:
    """Kind, start, end and value; matches that fail their test are dropped."""
    found = [("assign", *m.span(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]


def _value(kind: str, match: re.Match) -> str:
    """What is hashed: of a key block the body without line ends, so that keys differ; the header where there is none."""
    if kind != "block":
        return match[0]
    return LINE_ENDS.sub("", match["body"] or match["cut"] or "") or match["header"]


def _random(kind: str, value: str) -> bool:
    """Whether a value looks random; encoded keys hold runs of zero bytes, which read as A."""
    looked_at = ZERO_BYTES.sub("", value) if kind == "block" else value
    return not PLACEHOLDER.search(looked_at) and entropy(looked_at) >= LIVE_ENTROPY


def further_candidates(text: str, base: list[Candidate]) -> list[Candidate]:
    """Candidates of the further kinds that overlap none before them; a key block only has its header kept clear."""
    taken = sorted((a, b) for _, a, b, _ in base)
    found: list[Candidate] = []
    for kind, pattern in FURTHER:
        new = [((kind, *m.span(), _value(kind, m)), m.end("header") if kind == "block" else m.end())
               for m in pattern.finditer(text) if kind != "mixed" or _mixed(m[0])]
        ends, i = 0, 0
        kept = []
        for c, clear in new:  # both lists are in order of start
            while i < len(taken) and taken[i][0] < clear:
                ends = max(ends, taken[i][1])
                i += 1
            if ends <= c[1]:
                kept.append(c)
        found += kept
        taken = sorted([*taken, *((a, b) for _, a, b, _ in kept)])
    return found


def _mixed(value: str) -> bool:
    """Letters of both cases and digits, as in encoded random bytes."""
    return bool(re.search("[0-9]", value) and re.search("[a-z]", value) and re.search("[A-Z]", value)) and entropy(value) >= 3.5


def entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


CANDIDATES = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("hash", T.StringType()), T.StructField("random", T.BooleanType()),
]))


def candidates(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """The frame with the candidates in the place of the text."""
    import pyarrow as pa

    rest = [f for f in docs.schema.fields if f.name != text_col]
    schema = T.StructType([*rest, T.StructField(name, CANDIDATES)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string()), ("random", pa.bool_())]))

    def row(text: str) -> list[dict]:
        base = base_candidates(text)
        both = [*base, *further_candidates(text, base)]
        return [{"kind": k, "start": a, "end": b, "hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32],
                 "random": _random(k, v)} for k, a, b, v in both]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row(x.as_py() or "") for x in batch.column(text_col)]
            kept = [batch.column(f.name) for f in rest]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, kind)], names=[*(f.name for f in rest), name])

    return docs.mapInArrow(run, schema)


def scan(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text",
         example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Rows id, spans (kind, start, end, base, verdict, owners, repositories), ordered: one for each row of docs."""
    only = docs.select(F.col(id_col).alias("_id"), F.coalesce(owner.cast("string"), F.lit("")).alias("_owner"),
                       F.coalesce(repository.cast("string"), F.lit("")).alias("_repository"), whole_text(text_col).alias("_text"))
    found = candidates(only, "_text", "_found").select("*", F.monotonically_increasing_id().alias("_row"))
    rows = materialize(found, "secret-candidates")  # so that row numbers stay
    each = rows.select("_row", "_owner", "_repository", F.explode("_found").alias("c"))
    held = each.groupBy(F.col("c.hash").alias("_hash"), "_repository", "_owner").agg(F.count(F.lit(1)).alias("_n"))
    by_owner = held.groupBy("_hash", "_owner").agg(F.count(F.lit(1)).alias("_n"))
    counted = by_owner.groupBy("_hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("_n").alias("repositories"))
    judged = each.join(counted, each["c.hash"] == counted["_hash"]).select(
        "_row", "c.kind", "c.start", "c.end", F.col("c.kind").isin(*BASE).alias("base"), "owners", "repositories",
        F.when(F.col("owners") >= example_owners, "example").when(~F.col("c.random"), "placeholder").otherwise("live").alias("verdict"),
    ).where(F.col("base") | (F.col("verdict") == "live"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int")
    gathered = judged.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct(
        "start", order.alias("order"), "end", "kind", "base", "verdict", "owners", "repositories"))).alias("spans"))
    empty = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,base:boolean,verdict:string,owners:bigint,repositories:bigint>>")
    return rows.select("_row", F.col("_id").alias(id_col)).join(gathered, "_row", "left").select(
        id_col, F.coalesce("spans", empty).alias("spans"))
