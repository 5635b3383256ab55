import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from ledgerline.llm import byte_bpe, private_data
from ledgerline.llm.simhash import jaccard

from .conftest import ODD_ROWS
from .test_quality_rules import plain

WORDS = "river stone cloud garden window paper silver morning letter bridge forest candle mirror engine market pocket island winter".split()


def prose(seed, n=80):
    """The and of between words that no other text has in this order."""
    return " ".join(f"the {WORDS[(seed * 7 + i * (seed % 5 + 1)) % 18]}{seed}x{i} of" for i in range(n // 3))


def test_against_plain_versions(spark, frame, tmp_path):
    rows = [(i, prose(i), f"s{i % 3}") for i in range(40)]
    rows += [(100, prose(1), "s1"), (101, prose(2) + " more", "s2"), (102, prose(50) + " write to me@site.example.org or +1 (743) 555-3824", "s0"),
             (103, "too short", "s1"), (104, "# # # " * 20, "s1"), (105, prose(60), None), *ODD_ROWS]
    frame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    good = [r for r in rows if plain(r[1])[0] >= 10 and not r[1].startswith(("# #", "long text"))]
    kept = []
    for r in sorted(good, key=lambda r: r[0]):
        if all(jaccard(r[1], k[1], 5) < 0.8 for k in kept):
            kept.append(r)
    want = {}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    for i, text, source in kept:
        base, added = private_data.all_spans(text)
        masked = private_data.mask(text, private_data.listed({k: base[k] + added[k] for k in base}), "[{}]")
        want[i] = (source, library.encode_ordinary(masked), hashlib.sha256(masked.encode()).hexdigest())
    assert {100, 101}.isdisjoint(want) and "me@" not in library.decode(want[102][1])
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.source, list(r.ids), r.decoded_sha256) for r in found} == want and len(found) == len(want)


def test_stages_keep_columns_and_stand_empty_tables(spark, frame):
    docs = frame([(1, prose(1), "a"), (2, prose(2), None)])
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name
        assert stage(spark, docs, "").count() == 2 and stage(spark, empty, "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").collect() == []
