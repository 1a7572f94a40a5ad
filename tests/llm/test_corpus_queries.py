"""The registered corpus queries, beside SQL or plain programs, and the pipeline's stages."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import duck, rows_of_spark, rows_of_sql, types_of_spark, types_of_sql
from test_near_dup import brute as near_brute
from test_pii import check as pii_check

import __spark_entry__ as registered
import corpus_pipeline
from kinrank.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, name):
    connection = duck(FOLDER)
    found = QUERIES[name](spark, FOLDER)
    assert types_of_spark(found) == types_of_sql(connection, ORACLES[name])
    assert rows_of_spark(found) == rows_of_sql(connection, ORACLES[name])


def test_all_are_registered():
    names = registered.queries().keys()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= names
    assert registered.oracle_sql().keys() >= ORACLES.keys()


def test_op1(spark):
    pii_check(texts(spark), QUERIES["op1_pii"](spark, FOLDER).collect())


def test_op2_and_op7(spark):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("tokenizers")
    import base64

    import public_tokenizers

    from kinrank.llm.queries import VOCABULARY, WORDS

    with open(public_tokenizers.path(VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = tokenizers.Tokenizer.from_file(public_tokenizers.path(WORDS))
    one = {r.doc_id: tuple(r)[1:] for r in QUERIES["op2_byte_bpe"](spark, FOLDER).collect()}
    other = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_token_files"](spark, FOLDER).collect()}
    start = 0
    for doc_id, text in sorted(texts(spark)):
        ids = np.array(bpe.encode_ordinary(text), dtype="<u4")
        assert one.pop(doc_id) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        ids = np.array(words.encode(text, add_special_tokens=False).ids + [1], dtype="<u4")
        assert other.pop(doc_id) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not one and not other


def test_op6(spark):
    from test_embedding_dedup import brute

    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op6_embedding_near_dedup"](spark, FOLDER).collect()}
    assert found == brute(vectors)


def test_op10(spark):
    found = QUERIES["op10_minhash_near_dedup"](spark, FOLDER).collect()
    assert sorted(map(tuple, found)) == near_brute(texts(spark), 2)


def test_op11(spark):
    """The pages of the test tables have one template, which a few patterns can read."""
    import html

    found = {r.page_id: r for r in QUERIES["op11_main_text"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        (article,) = re.findall("<article>(.*?)</article>", page.html, re.S)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?p>|</?h1>", article)]
        want = "\n\n".join(b for b in blocks if b)
        assert (found[page.page_id].url, found[page.page_id].text) == (page.url, want)
        assert found[page.page_id].n_chars == len(want)


def test_op12(spark):
    from test_alignment import Libraries, plain

    rows = texts(spark)
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_tokenizer_alignment"](spark, FOLDER).collect()}
    assert [found[i] for i, _ in rows] == plain(Libraries.load(), [t for _, t in rows])


def test_pipeline_takes_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and ids; and tables without rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    some = docs.limit(60).collect()
    first = some[0].asDict()
    odd = [
        {**first, "doc_id": None},
        {**first, "text": None},
        {**first, "doc_id": 900_001, "text": None, "lang": None, "source": None, "n_chars": None},
        {**first, "doc_id": 900_002, "text": ""},
        {**first, "doc_id": 900_003, "text": "word " * 30_000},
        first,
        first,
    ]
    rows = [r.asDict() for r in some] + odd
    frame = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in rows], docs.schema)
    frame.write.parquet(f"{tmp_path}/odd/documents.parquet")
    labels.write.parquet(f"{tmp_path}/odd/labels.parquet")
    result = registered.queries()["pipeline"](spark, f"{tmp_path}/odd").collect()
    assert result and all(r.n_tokens >= 0 for r in result)
    by_text = {}
    for r in result:
        by_text.setdefault(r.decoded_sha256, set()).add(r.doc_id)
    # One document of each text is left, however many rows had it.
    assert all(len(ids) == 1 for ids in by_text.values())

    frame.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    assert registered.queries()["pipeline"](spark, f"{tmp_path}/none").collect() == []


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, held to a plain program."""
    from kinrank.llm import mixing, quality
    from kinrank.llm.queries import WEIGHTS
    from kinrank.session import written

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)

    model = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.scored(docs, model).collect() if r.predicted}
    kept = written(stages[names[0]](spark, docs, FOLDER))
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == good

    largest = {}
    for r in kept.collect():
        largest[r.text] = max(r.doc_id, largest.get(r.text, -1))
    kept = written(stages[names[1]](spark, kept, FOLDER))
    assert kept.columns == columns and sorted(r.doc_id for r in kept.collect()) == sorted(largest.values())

    before = [(r.doc_id, r.text) for r in kept.collect()]
    kept = written(stages[names[2]](spark, kept, FOLDER))
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, _, stays in near_brute(before, 5) if stays]

    mixture = mixing.fit_mixture(kept, WEIGHTS, floor=1.0)
    copies = {r.doc_id: r.copies for r in mixing.rates(kept, mixture).collect()}
    mixed = written(stages[names[3]](spark, kept, FOLDER))
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert mixed.columns == columns and counts == copies and min(counts.values()) >= 1

    last = stages[names[4]](spark, mixed, FOLDER).collect()
    text_of = dict(texts(spark))
    assert len(last) == sum(copies.values())
    assert all(r.decoded_sha256 == hashlib.sha256(text_of[r.doc_id].encode()).hexdigest() for r in last)
    whole = registered.queries()["pipeline"](spark, FOLDER).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last))
