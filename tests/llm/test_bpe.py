import hashlib
import random

import numpy as np
import pytest

from quarry.llm import bpe
from quarry.llm.queries import op9_bpe, tokenizer_path
from tests.conftest import SF_SMALL
from tests.llm import awkward

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(tokenizer_path())
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.WordEncoder(bpe.load_spec(tokenizer_path()))


def test_automaton_gives_the_librarys_ids_on_random_texts(library, encoder):
    rng = random.Random(3)
    letters = "aeiostrnhl'! .,0129éèßñİΣσς́  ​漢字한국😀🏽\n\t<|>²Ⅷ٣"
    for i in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 30)))
        if i % 40 == 0:
            text += rng.choice(["<|endoftext|>", " <|startoftext|>x", "don't we'll I'M"]) + text
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_runs_of_one_letter(library, encoder):
    for text in ["l" * n for n in range(1, 40)] + ["haha" * n for n in range(1, 9)] + ["!" * n for n in range(1, 20)]:
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_merge_lists_match_plain_merging():
    """Merging by rank, pair by pair, on random merge lists over a few letters."""
    rng = random.Random(5)
    for _ in range(60):
        labels, merges = list("ab"), []
        for _ in range(rng.randint(1, 8)):
            u, v = rng.choice(labels), rng.choice(labels)
            if u + v not in labels and len(u + v) < 7:
                merges.append((u, v))
                labels.append(u + v)
        automaton = bpe.MergeAutomaton(merges)
        automaton.index({x: i for i, x in enumerate([*labels, "a</w>", "b</w>"])})
        for _ in range(30):
            word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 10)))
            parts = [*word[:-1], word[-1] + "</w>"]
            for u, v in merges:
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == u and parts[i + 1] == v:
                        parts[i : i + 2] = [u + v]
                    i += 1
            assert [automaton.labels[x] for x in automaton.path(word)] == parts, (merges, word)


def test_awkward_documents_and_decoding(spark, library):
    df = awkward.documents(spark)
    done = bpe.encode(df, tokenizer_path(), out_col="ids", decoded_col="decoded")
    again = bpe.decode(done.select("text", "ids", "decoded"), tokenizer_path(), out_col="second")
    rows = again.collect()
    assert len(rows) == df.count()
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == r.second == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(awkward.empty(spark), tokenizer_path()).count() == 0


def test_unknown_and_null_ids(spark):
    df = spark.createDataFrame([(1, [518, 99_999, -1, 537]), (2, None), (3, [])], "i int, ids array<int>")
    assert {r.i: r.decoded for r in bpe.decode(df, tokenizer_path()).collect()} == {1: "the</w> and</w>", 2: "", 3: ""}


def test_query_matches_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op9_bpe(spark, SF_SMALL).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_files_with_other_parts_are_refused(tmp_path):
    import json

    with pytest.raises(ValueError, match="normalizer"):
        bpe.load_spec(tokenizer_path("byte_bpe_50k.json"))
    with open(tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    for part, change in (("pre_tokenizer", None), ("decoder", {"type": "ByteLevel"}), ("post_processor", {"type": "ByteLevel"}), ("model", spec["model"] | {"byte_fallback": True})):
        path = tmp_path / f"{part}.json"
        path.write_text(json.dumps(spec | {part: change}))
        with pytest.raises(ValueError, match=part):
            bpe.load_spec(str(path))


def test_kept_columns_travel_and_others_stay_behind(spark):
    df = spark.createDataFrame([(1, "Hello there", "x"), (2, None, "y")], "doc_id long, text string, ids string")
    done = bpe.encode(df, tokenizer_path(), decoded_col="decoded", keep=["doc_id"])
    assert done.columns == ["doc_id", "ids", "decoded"] and [len(r.ids) for r in done.orderBy("doc_id").collect()] == [2, 0]
    assert bpe.encode(df, tokenizer_path()).columns == ["doc_id", "text", "ids"]
