"""BPE encoding and decoding through a tokenisation automaton.

The merge list is compiled into a deterministic automaton over token labels by
one merge gadget per merge, in priority order. The automaton accepts exactly
the token sequences that byte-pair merging yields, so a word's encoding is its
single accepted path. For the merge ``u v -> w`` the gadget

* splits the state that ``u`` arcs enter (unless only ``u`` enters it, then and later),
* removes the ``v`` arc behind ``u``, and
* adds a ``w`` arc wherever a ``u`` arc leaves, into the state ``v`` arcs enter.

All arcs of one label enter one state (true at the start, and kept by the
gadget), so the automaton is an entry state per label and, per state, the set
of labels that may leave it. These sets are not copied on a split: a state
keeps its parent and the removals made since, and a (state, label) cell of the
transition table is worked out on first use and stored.

Encoding walks a word once: every prefix has one accepted path, so the last
token of the prefix ending at ``i`` is the one label that ends there and may
leave the state of the prefix before it. Decoding emits the arc labels of the
path, joined as the library's decode does for a model with no decoder.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

ROOT = 0
CACHE_WORDS = 200_000  # words whose ids a worker remembers; emptied when full
ROWS = 200  # rows handled at a time, which bounds a worker's scratch memory
END = "</w>"
STOP = "\x00"  # the letter that spells END; no byte stands for it


def byte_alphabet() -> list[str]:
    """The printable stand-in of every byte: itself if printable Latin-1, else 256, 257, ... in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class MergeAutomaton:
    """Deterministic automaton over token labels, compiled from a merge list."""

    def __init__(self, merges: list[tuple[str, str]]):
        self.enter: dict[str, int] = {}  # label -> state its arcs enter (ROOT if absent)
        self.sharers = [2]  # labels entering a state; ROOT is also the start and never exclusive
        self.parent, self.split_at = [ROOT], [-1]
        self.removed: dict[tuple[int, str], int] = {}
        self.born: dict[str, list[tuple[int, str]]] = {}  # label -> (merge number, left part)
        for t, (u, v) in enumerate(merges):
            self._gadget(t, u, v)
        self.end_time = len(merges)
        self.table: list[dict[int, int]] = [{} for _ in self.parent]

    def _gadget(self, t: int, u: str, v: str) -> None:
        state = self.enter.get(u, ROOT)
        if not self._allowed(state, v, t - 1):
            return  # v never follows u any more: the merge cannot apply
        target = self.enter.get(v, ROOT)
        if state == ROOT or self.sharers[state] > 1 or u == v:  # for u u, w enters the old state
            if state != ROOT:
                self.sharers[state] -= 1
            self.parent.append(state)
            self.split_at.append(t)
            self.sharers.append(1)
            self.enter[u] = state = len(self.parent) - 1
        self.removed[state, v] = t
        w = u + v
        if w not in self.born:
            self.enter[w] = target
            if target != ROOT:
                self.sharers[target] += 1
        self.born.setdefault(w, []).append((t, u))

    def _allowed(self, state: int, label: str, t: int) -> bool:
        """May ``label`` leave ``state`` after merges 0..t?"""
        while True:
            if self.removed.get((state, label), t + 1) <= t:
                return False
            split = self.split_at[state]
            births = self.born.get(label)
            if births is None:
                if len(label.removesuffix(END)) > 1:
                    return False  # its merge can never apply
                if state == ROOT:
                    return True
            else:
                for birth, left in births:
                    if split <= birth <= t and self._allowed(state, left, birth):
                        return True
                if state == ROOT:
                    return False
            state, t = self.parent[state], split - 1

    def index(self, labels: dict[str, int]) -> None:
        """Number the labels and build the matcher that names those ending at each letter of a word."""
        self.finder = ahocorasick.Automaton()
        self.labels = list(labels)
        for number, label in enumerate(self.labels):
            spelled = label.removesuffix(END) + STOP if label.endswith(END) and label != END else label
            self.finder.add_word(spelled, (number, len(spelled)))
        self.finder.make_automaton()

    def step(self, state: int, number: int) -> int:
        """The transition table's cell, filled on first use: the next state, or -1."""
        label = self.labels[number]
        to = self.enter.get(label, ROOT) if self._allowed(state, label, self.end_time) else -1
        self.table[state][number] = to
        return to

    def path(self, word: str) -> list[int]:
        """The label numbers of the accepted path that spells ``word`` (one letter a byte) and ends it."""
        n, table, step = len(word) + 1, self.table, self.step
        state, last, back = [ROOT] + [-1] * n, [0] * (n + 1), [0] * (n + 1)
        for at, (number, length) in self.finder.iter(word + STOP):
            i = at + 1
            if state[i] < 0:
                before = state[i - length]
                to = table[before].get(number) if before >= 0 else -1
                if to is None:
                    to = step(before, number)
                if to >= 0:
                    state[i], last[i], back[i] = to, number, i - length
        out = []
        while n:
            out.append(last[n])
            n = back[n]
        return out[::-1]


class WordEncoder:
    """Pre-splitting and the automaton for one tokenizer file's model."""

    def __init__(self, spec: dict):
        self.vocab: dict[str, int] = spec["vocab"]
        self.automaton = MergeAutomaton(spec["merges"])
        self.automaton.index({k: v for k, v in self.vocab.items() if k not in spec["special"]})
        self.arc_labels = label_array(self.vocab)
        self.numbers = [self.vocab[x] for x in self.automaton.labels]
        self.alphabet = byte_alphabet()
        self.special: dict[str, int] = spec["special"]
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(names) + ")") if names else None
        # The model's split pattern; \s spelled out as Unicode White_Space.
        space = r"\t-\r \x85\xa0  -     　"
        self.words = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{space}\p{{L}}\p{{N}}]+")
        self.known: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        """Ids of one pre-split word, as int32 bytes."""
        numbers = self.numbers
        letters = word if word.isascii() and word.isalnum() else "".join([self.alphabet[b] for b in word.encode("utf-8", "surrogatepass")])
        ids = array("i", [numbers[x] for x in self.automaton.path(letters)]).tobytes()
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        self.known[word] = ids
        return ids

    def plain(self, text: str, out: list[bytes]) -> None:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() alone is context-dependent here
        known, slow = self.known, self.word
        out.extend([known.get(w) or slow(w) for w in self.words.findall(text.lower())])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, as int32 bytes; special-token strings in it give their ids."""
        out: list[bytes] = []
        if text:
            if self.cut is None or "<|" not in text:
                self.plain(text, out)
            else:
                for i, piece in enumerate(self.cut.split(text)):
                    if i % 2:
                        out.append(np.int32(self.special[piece]).tobytes())
                    elif piece:
                        self.plain(piece, out)
        return b"".join(out)


# What a tokenizer file must say for the parts that are built in here.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
MODEL = {"type": "BPE", "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "unk_token": None, "byte_fallback": False, "dropout": None, "ignore_merges": False}


def load_spec(path: str) -> dict:
    """The parts of a ``tokenizers`` JSON file that the automaton needs (read on the driver, a few MB).

    Normalisation, word split and word ends are built in. A file that asks for
    others (a byte-level model without word ends, say) raises ``ValueError``.
    """
    with open(path, encoding="utf-8") as f:
        j = json.load(f)
    says = {
        "normalizer": ((j["normalizer"] or {}).get("normalizers"), NORMALIZERS),
        "pre_tokenizer": ((j["pre_tokenizer"] or {}).get("pretokenizers"), PRE_TOKENIZERS),
        "post_processor": (j["post_processor"], None),
        "decoder": (j["decoder"], None),
        "model": ({k: j["model"].get(k) for k in MODEL}, MODEL),
        "added_tokens": ([a["content"] for a in j["added_tokens"] if a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"]], []),
    }
    for part, (found, built_in) in says.items():
        if found != built_in:
            raise ValueError(f"{path}: {part} {str(found)[:200]} is not supported, only {str(built_in)[:300]}")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in j["model"]["merges"]]
    special = {a["content"]: a["id"] for a in j["added_tokens"] if a["special"]}
    return {"merges": merges, "vocab": j["model"]["vocab"] | special, "special": special}


_encoders: dict[str, WordEncoder] = {}  # one per worker process and tokenizer file


def _encoder(path: str, shipped) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(shipped.value)
    return _encoders[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids", decoded_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``out_col`` array<int>: the token ids of every whole text.

    With ``decoded_col`` the same worker also decodes those ids (see
    :func:`decode`), which saves a second trip of the ids through Python.
    ``keep`` names the columns to hand on (default: all), so that texts need not
    travel back. A null or empty text has no ids and decodes to an empty text.
    Rows are independent: repeated rows give repeated results, an empty table
    an empty one, and columns already named like an output are replaced. A
    worker keeps one automaton, at most ``CACHE_WORDS`` encoded words, a batch
    of rows and the results of ``ROWS`` of them.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(load_spec(path))  # one file, a few MB
    outputs = [out_col, *([decoded_col] if decoded_col else [])]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in outputs]
    rows = docs.select(*dict.fromkeys([*kept, text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, shipped)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                made = _encoded(enc, part[text_col], decoded_col is not None)
                yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), *made], [*kept, *outputs])
            pa.default_memory_pool().release_unused()

    types = [ArrayType(IntegerType()), StringType()]
    shape = StructType([*(rows.schema[c] for c in kept), *(StructField(c, t) for c, t in zip(outputs, types, strict=False))])
    return rows.mapInArrow(run, shape)


def _encoded(enc: WordEncoder, texts: pa.Array, decode_too: bool) -> list[pa.Array]:
    parts = [enc.encode(t.as_py()) for t in texts]
    ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype(np.int32)
    ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(parts), np.int32))
    return [ids, _joined(ids, enc.arc_labels)] if decode_too else [ids]


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add ``out_col`` string: the labels of the ids' arcs, joined by one space.

    That is the library's ``decode`` for a model without a decoder. Null ids
    give an empty text; an id outside the vocabulary is skipped as there.
    """
    shipped = df.sparkSession.sparkContext.broadcast(load_spec(path)["vocab"])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labels = label_array(shipped.value)
        for ids in batches:
            rows = [_joined(ids.slice(at, ROWS), labels) for at in range(0, len(ids), ROWS)]
            yield pa.concat_arrays(rows) if rows else pa.array([], pa.string())

    udf = F.arrow_udf(_typed(run), "string")
    return df.withColumn(out_col, udf(F.col(ids_col)))


def label_array(vocab: dict[str, int]) -> pa.Array:
    """Label by id; null where an id has none."""
    names: list[str | None] = [None] * (max(vocab.values(), default=-1) + 1)
    for label, i in vocab.items():
        names[i] = label
    return pa.array(names, pa.string())


def _joined(ids: pa.Array, labels: pa.Array) -> pa.Array:
    ids = pc.fill_null(ids, pa.scalar([], ids.type))
    flat = ids.flatten()
    bad = pc.fill_null(pc.or_(pc.less(flat, 0), pc.greater_equal(flat, len(labels))), True)
    picked = labels.take(pc.if_else(bad, None, flat))
    if picked.null_count:
        lengths = pc.list_value_length(ids).to_pylist()
        values, at, rows = picked.to_pylist(), 0, []
        for n in lengths:
            rows.append(" ".join([x for x in values[at : at + n] if x is not None]))
            at += n
        return pa.array(rows, pa.string())
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))]).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(ends, picked), pa.scalar(" ", pa.string()))


def _typed(run):
    """Give the closure the hints that tell Spark it is an iterator UDF."""
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run
