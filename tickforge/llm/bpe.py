"""Byte-pair encoding and decoding with a deterministic token automaton.

The automaton accepts exactly the token sequences that byte-pair merging produces. It is
built from one state with a loop for every byte by one gadget per merge, in merge order.
For the merge (a, b) -> c at time k:

* the state that arcs labelled ``a`` enter is replaced by a copy without the arc ``b``;
* every state with an arc ``a`` gets an arc ``c``, which enters the state that ``b`` entered.

So the state after an arc depends on its label alone, and is the label's *owner* state at
some time. The gadgets are kept as arrays (``left``, ``right``, ``born``) and one table of
removed arcs; whether a state has an arc is read from them on first use and then kept in the
transition table, which therefore holds only pairs of labels that occur.

A pre-split word is encoded by following arcs from each byte position: exactly one accepted
path reaches each position, so the work is linear in the word's length. Decoding emits the
byte labels of the arcs.
"""

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import in_slices, pick, remembers

#: Distinct words a worker remembers before it starts anew, and the longest it keeps.
CACHE_WORDS = 400_000
CACHE_CHARS = 48
#: Entries of the transition table of one worker.
TABLE_ARCS = 1_000_000

# Fixed value: the byte-level pre-split pattern of this family of tokenizers.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same pattern for texts of ASCII alone, which the standard library matches faster.
ASCII_SPLIT = SPLIT.replace(r"[^\s\p{L}\p{N}]", "[^\\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]")
ASCII_SPLIT = ASCII_SPLIT.replace(r"\p{N}", "[0-9]")


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in vocabulary files."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def read_tokenizer(path: str) -> dict:
    """Vocabulary, merges and special tokens of a tokenizer file, with byte labels."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    alphabet = byte_alphabet()

    def to_bytes(token):
        return bytes(alphabet[c] for c in token)

    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocab = {to_bytes(t): n for t, n in spec["model"]["vocab"].items() if t not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    merges = [(vocab[to_bytes(a)], vocab[to_bytes(b)]) for a, b in pairs]
    return {"vocab": vocab, "merges": merges, "special": special}


class Automaton:
    """The token automaton of one tokenizer, with its encoder and decoder.

    A file in which several merges make the same token is refused with a ValueError: arcs are
    undone along one derivation of a token.
    """

    def __init__(self, vocab: dict[bytes, int], merges, special: dict[str, int]):
        self.special = special
        size = max([*vocab.values(), *special.values()], default=-1) + 1
        self.labels = [b""] * size
        for label, token in vocab.items():
            self.labels[token] = label
        for text, token in special.items():
            self.labels[token] = text.encode()
        self._compile(vocab, merges, size)
        # Every prefix of a label: the token it is, or -1 where the label goes on.
        self.prefixes = {}
        for label in sorted(vocab, key=len):
            for end in range(1, len(label)):
                self.prefixes.setdefault(label[:end], -1)
            self.prefixes[label] = vocab[label] if self.reachable[vocab[label]] else -1
        self.table: dict[int, bool] = {}
        self.words = _Words(self)
        self.wide_split = regex.compile(SPLIT).findall
        self.ascii_split = re.compile(ASCII_SPLIT, re.ASCII).findall
        self.cut = None
        if special:
            longest_first = sorted(special, key=len, reverse=True)
            self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")")

    def _compile(self, vocab, merges, size):
        """One gadget per merge, in order."""
        self.size = size
        self.left, self.right, self.born = [-1] * size, [-1] * size, [-1] * size
        self.removed: dict[int, int] = {}
        self.reachable = [len(label) == 1 for label in self.labels]
        for time, (a, b) in enumerate(merges):
            joined = vocab[self.labels[a] + self.labels[b]]
            # The copy of a's state loses arc b.
            self.removed[a * size + b] = time
            # Arc c leaves wherever arc a leaves, and enters the state of b.
            if self.reachable[joined]:
                label = self.labels[joined]
                raise ValueError(f"token {label!r} has several merges; gadgets are built for one")
            self.reachable[joined] = True
            self.left[joined], self.right[joined], self.born[joined] = a, b, time

    def _has_arc(self, owner: int, label: int) -> bool:
        """Whether the state after ``owner`` has the arc ``label``.

        Copies are undone from the youngest gadget to the oldest: a state younger than the
        label goes back to what it was copied from, a label younger than the state to the
        arc it was laid beside.
        """
        removed, size, born = self.removed, self.size, self.born
        until = len(removed)
        while True:
            time = removed.get(owner * size + label)
            if time is not None and time <= until:
                return False
            state_born, label_born = born[owner], born[label]
            if state_born < 0 and label_born < 0:
                return True
            if state_born > label_born:
                until, owner = min(until, state_born - 1), self.right[owner]
            else:
                until, label = min(until, label_born), self.left[label]

    def arc(self, owner: int, label: int) -> bool:
        key = owner * self.size + label
        found = self.table.get(key)
        if found is None:
            if len(self.table) >= TABLE_ARCS:
                self.table.clear()
            found = self.table[key] = self._has_arc(owner, label)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word."""
        n = len(word)
        last = [-1] * (n + 1)  # the token whose arc ends here
        prefixes, table, size = self.prefixes, self.table, self.size
        for start in range(n):
            before = last[start]
            base = before * size
            for end in range(start + 1, n + 1):
                token = prefixes.get(word[start:end])
                if token is None:
                    break
                if token >= 0 and last[end] < 0:
                    if before < 0:
                        last[end] = token
                    else:
                        found = table.get(base + token)
                        if self.arc(before, token) if found is None else found:
                            last[end] = token
        ids = []
        while n:
            ids.append(last[n])
            n -= len(self.labels[last[n]])
        return ids[::-1]

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers. Null counts as empty."""
        if not text:
            return b""
        if self.cut and any(s in text for s in self.special):
            parts = []
            for n, part in enumerate(self.cut.split(text)):
                parts.append(self.special[part].to_bytes(4, "little") if n % 2 else self._run(part))
            return b"".join(parts)
        return self._run(text)

    def _run(self, text: str) -> bytes:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        split = self.ascii_split if text.isascii() else self.wide_split
        return b"".join(map(self.words.__getitem__, split(text)))

    def decode(self, ids: bytes | None) -> str:
        """Text of packed ids: the labels of their arcs, in order."""
        tokens = np.frombuffer(ids or b"", "<u4").tolist()
        return b"".join(map(self.labels.__getitem__, tokens)).decode("utf-8", "replace")


class _Words(dict):
    """Packed ids of words seen before by this worker."""

    def __init__(self, automaton):
        self.automaton = automaton

    def __missing__(self, word):
        ids = np.array(self.automaton.encode_word(word.encode()), "<u4").tobytes()
        if len(word) <= CACHE_CHARS:
            self[word] = ids
        return ids


_BUILT: dict[str, Automaton] = {}
remembers(__name__, _BUILT.clear)


def _automaton(path, spec) -> Automaton:
    """Built once in each Python worker."""
    if path not in _BUILT:
        _BUILT[path] = Automaton(**spec)
    return _BUILT[path]


def _broadcast(df, tokenizer_path):
    # One tokenizer file, a few megabytes whatever the size of the data.
    return df.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))


def encode(
    df: DataFrame, tokenizer_path: str, doc_id="doc_id", text="text", decoded=False
) -> DataFrame:
    """Token ids of every whole text: (doc_id, ids[, decoded]).

    ``ids`` is binary, little-endian unsigned 32-bit integers. With ``decoded`` the same pass
    also decodes them again. Null and empty texts give no ids; repeated rows stay repeated;
    other columns are left out. No shuffle: each row is encoded where it was read.
    """
    spec = _broadcast(df, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]):
        bpe = _automaton(tokenizer_path, spec.value)
        for batch in batches:
            ids = [bpe.encode(text) for text in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array(map(bpe.decode, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = pick(df, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary" + ", decoded string" * decoded
    names = ["doc_id", "ids", "decoded"][: 2 + decoded]
    return rows.mapInArrow(in_slices(run), schema)


def decode(df: DataFrame, tokenizer_path: str, doc_id="doc_id", ids="ids") -> DataFrame:
    """Texts of packed ids: (doc_id, text). Null ids give the empty text."""
    spec = _broadcast(df, tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]):
        bpe = _automaton(tokenizer_path, spec.value)
        for batch in batches:
            texts = pa.array(map(bpe.decode, batch.column(1).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "text"])

    rows = pick(df, doc_id=doc_id, ids=ids)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(in_slices(run), f"doc_id {kind}, text string")


def token_count(ids="ids") -> F.Column:
    return (F.octet_length(ids) / 4).cast("long")
