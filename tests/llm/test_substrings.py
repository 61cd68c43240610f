import hashlib
import random
from collections import Counter

import pytest

from quarry.llm import substrings
from quarry.llm.queries import op3_substrings
from quarry.llm.words import window_hashes, word_hashes
from tests.conftest import SF_SMALL
from tests.llm import awkward


def brute(texts, width):
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        cover = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                cover[i : i + width] = [True] * width
        out.append((len(w), sum(cover), b" ".join(x for x, c in zip(w, cover, strict=True) if not c).decode("utf-8", "surrogatepass")))
    return out


@pytest.mark.parametrize("width", [1, 4, 12, 35])
def test_cuts_match_brute_force_on_repetitive_texts(spark, width):
    rng = random.Random(width)
    texts = [" ".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.repeats(df, width).collect()}
    assert got == dict(enumerate(brute(texts, width)))


def brute_keeping_first(texts, width):
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    met, out = set(), []
    for w in words:
        cover, spared = [False] * len(w), [False] * len(w)
        for i in range(len(w) - width + 1):
            window = tuple(w[i : i + width])
            if seen[window] > 1:
                cover[i : i + width] = [True] * width
                if window not in met:
                    spared[i : i + width] = [True] * width
                met.add(window)
        out.append((len(w), sum(c and not s for c, s in zip(cover, spared, strict=True)), b" ".join(x for x, c, s in zip(w, cover, spared, strict=True) if s or not c).decode("utf-8", "surrogatepass")))
    return out


@pytest.mark.parametrize("width", [1, 4, 12])
def test_first_occurrences_stay_whole(spark, width):
    rng = random.Random(width)
    texts = [" ".join(rng.choice("ab") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    near = " ".join(f"w{i}" for i in range(40))
    texts += [near, near + " end", "start " + near]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.repeats(df, width, keep_first=True).collect()}
    assert got == dict(enumerate(brute_keeping_first(texts, width)))
    assert got[60][2] == near


def test_awkward_documents(spark):
    df = awkward.documents(spark)
    given = df.select("doc_id", "text").collect()
    rows = substrings.repeats(df, 35).collect()
    want = [(g.doc_id, *b) for g, b in zip(given, brute([g.text for g in given], 35), strict=True)]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows), key=repr) == sorted(want, key=repr)
    for r in rows:
        assert sum(s.length for s in r.spans) == r.n_removed
    assert substrings.repeats(awkward.empty(spark), 35).count() == 0


def test_equal_windows_elect_equal_seeds():
    rng = random.Random(2)
    words = " ".join(rng.choice("abc") for _ in range(300)).encode()
    hashes = word_hashes(words)
    seeds, chosen = substrings.elected(hashes, 20, 5)
    windows = window_hashes(hashes, 20)
    by_window = {}
    for i, w in enumerate(windows.tolist()):
        assert by_window.setdefault(w, chosen[i] - i) == chosen[i] - i


def test_word_hashes_follow_the_words_in_blocks(monkeypatch):
    from quarry.llm import words

    raw = " ".join(f"w{i % 50}" for i in range(500)).encode() + b"\t\n x " + b"y" * 100
    whole = word_hashes(raw).tolist()
    monkeypatch.setattr(words, "BLOCK", 37)
    assert word_hashes(raw).tolist() == whole and len(whole) == len(raw.split())
    assert len(set(whole)) == len(set(raw.split()))


def thue_morse(n, one="a", two="b"):
    return "".join((one, two)[i.bit_count() % 2] for i in range(n))


def test_texts_made_to_collide_under_polynomial_hashes_do_not(spark):
    pairs = [(thue_morse(1024), thue_morse(1024, "b", "a")), (thue_morse(64, "ab", "ba"), thue_morse(64, "ba", "ab"))]
    texts = []
    for n, (one, two) in enumerate(pairs):
        around = [f"w{n}x{i}" for i in range(34)]
        texts += [" ".join([*around[:17], one, *around[17:]]), " ".join([*around[:17], two, *around[17:]])]
    texts += [" ".join(thue_morse(2048)), " ".join(thue_morse(2048, "c", "d"))]  # windows of words this time
    rng = random.Random(5)
    base = [rng.choice("pq") for _ in range(40)]
    for i in range(200):  # all differ in a few words only
        texts.append(" ".join([f"n{i}", *(w if rng.random() > 0.1 else "r" for w in base)]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.repeats(df, 35).collect()}
    want = dict(enumerate(brute(texts, 35)))
    assert got == want and all(want[i][1] == 0 for i in range(4))


def test_word_and_window_hashes_tell_like_ones_apart():
    rng = random.Random(6)
    words = {b"a" * n for n in range(1, 200)} | {bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 90))) for _ in range(3000)}
    words |= {thue_morse(1024).encode(), thue_morse(1024, "b", "a").encode()}
    for lane in (0, 1):
        assert len(set(word_hashes(b" ".join(words), lane=lane).tolist())) == len(words)
    for width in (1, 2, 3, 7, 32, 35):
        text = [rng.choice("ab") for _ in range(2000)]
        hashes = window_hashes(word_hashes(" ".join(text).encode()), width).tolist()
        windows = ["".join(text[i : i + width]) for i in range(len(hashes))]
        assert len(hashes) == 2001 - width and len(set(hashes)) == len(set(windows)) == len(set(zip(hashes, windows, strict=True)))


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: (n, r, hashlib.sha256(k.encode()).hexdigest()) for d, (n, r, k) in zip(docs, brute([d.text for d in docs], 35), strict=True)}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in op3_substrings(spark, SF_SMALL).collect()} == want
