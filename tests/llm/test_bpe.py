import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from genoframe.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")
PATH = queries.vocabulary(queries.BYTE_BPE)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


HARD = ["", " ", "aaaaaaaaaaaaaaa", "  two  spaces \n\n\t x", "<|endoftext|>a<|endoftext|><|endoftext|>", "don't we'll I'M", "éèê über ñandú 漢字 🙂🙂", "x" * 5000, "-" * 3000 + "=" * 777, "12345678901234567890", "\x00\x01\x7f   　", "thererererehehehe" * 50, "á" * 9]


@pytest.mark.parametrize("text", HARD)
def test_same_ids_as_the_library(library, text):
    ids = bpe.encoder(PATH).encode(text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert bpe.encoder(PATH).decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=60), st.text("abeht <|>\n'", max_size=80)))
def test_same_ids_on_random_texts(text):
    library = tokenizers.Tokenizer.from_file(PATH) if not hasattr(test_same_ids_on_random_texts, "t") else test_same_ids_on_random_texts.t
    test_same_ids_on_random_texts.t = library
    assert bpe.encoder(PATH).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_every_token_encodes_to_itself(library):
    e = bpe.encoder(PATH)
    for i in range(0, 50256, 7):
        data = e.bytes_of[i].decode("latin-1")
        try:
            text = e.bytes_of[i].decode("utf-8")
        except UnicodeDecodeError:
            continue
        assert e.encode_piece(text) == [i], (i, data)


def test_frames(spark, library):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("text", T.StringType())])
    rows = [(i, "clash", t) for i, t in enumerate([*HARD, None])] + [(0, None, "again"), (None, None, "no id")]
    got = {(r.doc_id, tuple(r.ids)): r.decoded for r in bpe.decode(bpe.encode(spark.createDataFrame(rows, schema), PATH), PATH).collect()}
    assert got == {(i, tuple(library.encode(t or "", add_special_tokens=False).ids)): t or "" for i, _, t in rows}
    assert bpe.encode(spark.createDataFrame([], schema), PATH).count() == 0


def test_query(spark, library, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op3_bpe(spark, sf_dir).collect():
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_vocabularies_that_need_more_are_refused(tmp_path):
    import json

    import pytest

    from genoframe.llm import bpe, queries

    with open(queries.vocabulary(queries.BYTE_BPE), encoding="utf-8") as f:
        spec = json.load(f)
    for change in ({"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]}, {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}):
        path = tmp_path / "v.json"
        path.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError, match="supported"):
            bpe.PrefixEncoder(str(path))


def test_bounded_memos_change_nothing():
    path = PATH
    texts = [" ".join(f"w{k * k % 977}x{k % 13}" for k in range(n, n + 60)) for n in range(40)]
    small, whole = bpe.PrefixEncoder(path, (20, 30)), bpe.PrefixEncoder(path)
    assert [small.encode(t) for t in texts] == [whole.encode(t) for t in texts]
    assert len(small.memo) <= 20 and len(small.memo.older) <= 20 and len(small.compatible_pairs) <= 30
