"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

Leaf ``i`` of the tree holds the merge rank of the pair that starts at symbol
``i`` (infinity when it cannot merge); an inner node holds the smaller rank of
its children and, on a tie, the left one.  So the root names the leftmost
lowest-rank merge; a merge changes at most three leaves, each a point update of
logarithmic depth, until the root is infinity.

The vocabulary is a ``tokenizers`` JSON file (BPE with an end-of-word suffix,
NFC, white space dropped, lower case, byte-level symbols); merges, added tokens
and suffix are read from it.  Nothing is trained.

Documents are encoded inside the partition that holds them (``mapInArrow``):
no shuffle and nothing collected.  Each distinct word of an Arrow batch is
encoded once; the trees of all these words are updated together as numpy rows.

Defined results: a null or empty text encodes to no ids and decodes to the
empty string.  A one-word text of any length costs n log n.  Repeated rows give
repeated results; extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame

from almanac.llm.common import columns, slices

# Unicode White_Space, the byte-level alphabet's printable ranges
# and the word pattern of this tokenizer family.
SPACE = "\t-\r \x85\xa0  -     　"
PRINTABLE = (("!", "~"), ("\xa1", "\xac"), ("\xae", "\xff"))
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + SPACE + r"\p{L}\p{N}]+"

#: Control characters at which ``str.split`` cuts although they are no Unicode white space.
_ODD = regex.compile("[\x1c-\x1f]")
_SPLIT = regex.compile(f"[{SPACE}]+")
_WORD = regex.compile(WORD)
_NEVER = 1 << 60

#: No rank, in the arrays of :class:`BatchBpe`.
NONE = np.int32(1 << 30)
#: Texts that :class:`BatchBpe` hands to :class:`Bpe`: added tokens, control characters
#: and letters outside the Latin blocks, for which the two libraries' tables may differ.
ALONE = r"<\||[\x{1c}-\x{1f}]|\x{130}|[^\x{0}-\x{24f}\x{300}-\x{36f}\x{2010}-\x{2027}\x{2030}-\x{205e}]"
MARKS = r"[\x{300}-\x{36f}]"


def byte_alphabet() -> list[str]:
    """The character for each of the 256 bytes: itself where printable, else
    the next free one from U+0100 on."""
    own = {b for lo, hi in PRINTABLE for b in range(ord(lo), ord(hi) + 1)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in own else free))
        free += b not in own
    return out


class Bpe:
    def __init__(self, spec: dict, remember: int = 150_000):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.added = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.tokens.update({i: t for t, i in self.added.items()})
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        alphabet = byte_alphabet()
        self.byte_of = {c: b for b, c in enumerate(alphabet)}
        self.inner = [self.vocab.get(c) for c in alphabet]
        self.last = [self.vocab.get(c + self.suffix) for c in alphabet]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.remember = remember
        self.words: dict[str, tuple[int, ...]] = {}

    # -- one word ---------------------------------------------------------
    def merge(self, ids: list[int]) -> list[int]:
        """Merge adjacent pairs, lowest rank first and leftmost among equals."""
        n = len(ids)
        if n < 2:
            return ids
        find = self.merges.get
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        best = [_NEVER] * (2 * size)   # rank at each node
        made = [0] * n                 # symbol the pair at this place becomes
        for i in range(n - 1):
            if m := find((ids[i], ids[i + 1])):
                best[size + i], made[i] = m
        for x in range(size - 1, 0, -1):
            a, b = best[2 * x], best[2 * x + 1]
            best[x] = a if a <= b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def put(place: int, rank: int) -> None:
            x = size + place
            if best[x] == rank:
                return
            best[x] = rank
            x >>= 1
            while x:
                a, b = best[2 * x], best[2 * x + 1]
                low = a if a <= b else b
                if best[x] == low:
                    return
                best[x] = low
                x >>= 1

        while (rank := best[1]) != _NEVER:
            x = 1
            while x < size:            # down to the leftmost leaf with the root's rank
                x *= 2
                if best[x] != rank:
                    x += 1
            i = x - size
            j = after[i]
            ids[i] = made[i]
            alive[j] = False
            k = after[i] = after[j]
            if j < n - 1:
                put(j, _NEVER)
            if k < n:
                before[k] = i
                if m := find((ids[i], ids[k])):
                    made[i] = m[1]
                    put(i, m[0])
                else:
                    put(i, _NEVER)
            else:
                put(i, _NEVER)
            if (h := before[i]) >= 0:
                if m := find((ids[h], ids[i])):
                    made[h] = m[1]
                    put(h, m[0])
                else:
                    put(h, _NEVER)
        return [t for t, keep in zip(ids, alive) if keep]

    def word(self, word: str) -> tuple[int, ...]:
        got = self.words.get(word)
        if got is None:
            raw = word.encode("utf-8", "replace")
            symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
            got = tuple(self.merge([s for s in symbols if s is not None]))
            if len(word) <= 64:
                if len(self.words) >= self.remember:
                    self.words.clear()
                self.words[word] = got
        return got

    # -- one text ---------------------------------------------------------
    def chunk(self, chunk: str) -> list[int]:
        """Ids of a piece without white space."""
        s = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
        s = "".join(c.lower() for c in s) if "Σ" in s else s.lower()
        out: list[int] = []
        for w in _WORD.findall(s):
            out += self.word(w)
        return out

    def parts(self, text: str | None) -> Iterator[tuple[str, bool]]:
        """The chunks of a text in order, and whether each is an added token."""
        if not text:
            return
        for i, piece in enumerate(self.cut.split(text) if self.cut else [text]):
            if i % 2:
                yield piece, True
            else:
                for c in _SPLIT.split(piece) if _ODD.search(piece) else piece.split():
                    if c:
                        yield c, False

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for c, special in self.parts(text):
            if special:
                out.append(self.added[c])
            else:
                out += self.chunk(c)
        return out

    def decode(self, ids) -> str:
        """Tokens joined by a space: what the file's missing decoder means."""
        return " ".join(self.tokens[i] for i in ids)

    def decode_text(self, ids) -> str:
        """The normalised text again: bytes put back, one space after each word."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            t = self.tokens[i]
            if t in self.added:
                out += [raw.decode("utf-8", "replace"), t]
                raw.clear()
                continue
            ended = bool(self.suffix) and t.endswith(self.suffix)
            raw += bytes(self.byte_of[c] for c in (t[:-len(self.suffix)] if ended else t))
            if ended:
                raw += b" "
        return "".join([*out, raw.decode("utf-8", "replace")])


class BatchBpe:
    """The same tree for many words at once: row ``w`` of each array is one
    word, and a round merges once in every word whose root is not infinity."""

    LIMIT = 64   # longer words go through :meth:`Bpe.merge` alone

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        none = -1
        self.inner = np.array([none if x is None else x for x in bpe.inner], np.int32)
        self.last = np.array([none if x is None else x for x in bpe.last], np.int32)
        self.made = np.empty(len(bpe.merges), np.int32)
        bits = max(10, (4 * len(bpe.merges)).bit_length())
        self.shift = np.uint64(64 - bits)
        keys = np.empty(len(bpe.merges), np.uint64)
        for (a, b), (rank, new) in bpe.merges.items():
            self.made[rank] = new
            keys[rank] = a << 32 | b
        self.key = np.full((1 << bits) + 64, np.uint64(2**64 - 1))
        self.rank = np.full(len(self.key), NONE, np.int32)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):               # every key to the next free slot from its own on
            free = self.rank[at] == NONE
            first = np.zeros(len(todo), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.key[at[put]], self.rank[at[put]] = keys[todo[put]], todo[put]
            todo, at = todo[~put], at[~put] + 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it cannot merge."""
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        at = self._slot(key)
        out = np.full(len(key), NONE, np.int32)
        todo = np.arange(len(key))
        while len(todo):
            here, rank = self.key[at], self.rank[at]
            hit = here == key[todo]
            out[todo[hit]] = rank[hit]
            go = ~hit & (rank != NONE)
            todo, at = todo[go], at[go] + 1
        return out

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in order, and where each word's ids start
        (one more entry at the end)."""
        words = words.cast(pa.large_string())
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        length = np.diff(bounds)
        counts = np.zeros(len(words), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        low = 0
        for size in (1, 2, 4, 8, 16, 32, self.LIMIT):
            pick = np.flatnonzero((length > low) & (length <= size + 1))
            low = size + 1
            for part in (pick[i:i + 100_000] for i in range(0, len(pick), 100_000)):
                ids, counts[part] = self._class(raw, bounds[part], length[part], size)
                done.append((part, ids))
        for w in np.flatnonzero(length > low):
            ids = self.bpe.word(words[int(w)].as_py())
            counts[w] = len(ids)
            done.append((np.array([w]), np.array(ids, np.int32)))
        starts = np.concatenate(([0], np.cumsum(counts)))
        out = np.empty(starts[-1], np.int32)
        for part, ids in done:
            out[ragged(starts[part], counts[part])] = ids
        return out, starts

    def _class(self, raw, begin, n, size):
        """Words of at most ``size + 1`` bytes."""
        W, L = len(n), size + 1
        col = np.arange(L)
        real = col < n[:, None]
        byte = raw[np.where(real, begin[:, None] + col, 0)]
        ids = np.where(col == n[:, None] - 1, self.last[byte], self.inner[byte])
        ids[~real] = 0
        if (ids[real] < 0).any():      # a byte the vocabulary lacks is left out
            raise ValueError("the vocabulary lacks a byte")
        tree = np.full((W, 2 * size), NONE, np.int32)
        pair = real[:, 1:]
        tree[:, size:][pair] = self.find(ids[:, :-1][pair], ids[:, 1:][pair])
        x = size
        while x > 1:
            tree[:, x // 2:x] = np.minimum(tree[:, x:2 * x:2], tree[:, x + 1:2 * x:2])
            x //= 2
        after = np.broadcast_to(col + 1, (W, L)).astype(np.int16)
        before = np.broadcast_to(col - 1, (W, L)).astype(np.int16)
        alive = real.copy()
        T, I, A, P, K = tree.reshape(-1), ids.reshape(-1), after.reshape(-1), before.reshape(-1), alive.reshape(-1)
        w = np.flatnonzero(tree[:, 1] != NONE)
        while len(w):
            t, s = w * (2 * size), w * L
            rank = T[t + 1]
            x = np.ones(len(w), np.int64)
            for _ in range(size.bit_length() - 1):
                x *= 2
                x += T[t + x] != rank
            i = x - size
            j = A[s + i].astype(np.int64)
            k = A[s + j].astype(np.int64)
            h = P[s + i].astype(np.int64)
            I[s + i] = self.made[rank]
            A[s + i] = k
            K[s + j] = False
            inside, left = k < n[w], h >= 0
            P[(s + k)[inside]] = i[inside]
            shut = j < n[w] - 1
            T[(t + size + j)[shut]] = NONE
            fresh = np.full(len(w), NONE, np.int32)
            fresh[inside] = self.find(I[(s + i)[inside]], I[(s + k)[inside]])
            T[t + size + i] = fresh
            T[(t + size + h)[left]] = self.find(I[(s + h)[left]], I[(s + i)[left]])
            spots = [(t[shut], (size + j[shut]) >> 1), (t, (size + i) >> 1), (t[left], (size + h[left]) >> 1)]
            for _ in range(size.bit_length() - 1):
                for q, (base, at) in enumerate(spots):
                    T[base + at] = np.minimum(T[base + 2 * at], T[base + 2 * at + 1])
                    spots[q] = (base, at >> 1)
            w = w[T[t + 1] != NONE]
        return ids[alive], alive.sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and where each text's ids start.
        Each distinct word of the batch is encoded once."""
        texts = texts.cast(pa.large_string()).fill_null("")
        alone = pc.match_substring_regex(texts, ALONE).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(alone), "", texts) if alone.any() else texts
        lists = pc.utf8_split_whitespace(plain)
        chunks = lists.flatten().dictionary_encode()
        per_text = pc.list_value_length(lists).to_numpy().astype(np.int64)
        forms = chunks.dictionary
        marked = pc.match_substring_regex(forms, MARKS)
        if pc.any(marked).as_py():     # all other letters left here are in NFC already
            composed = [unicodedata.normalize("NFC", c) for c in forms.filter(marked).to_pylist()]
            forms = pc.replace_with_mask(forms, marked, pa.array(composed, forms.type))
        forms = pc.utf8_lower(forms)
        lists = pc.utf8_split_whitespace(pc.replace_substring_regex(forms, f"({WORD})", r"\1 "))
        words = lists.flatten().dictionary_encode()
        per_chunk = pc.list_value_length(lists).to_numpy().astype(np.int64)
        empty = pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)
        ids, starts = self.words(words.dictionary)
        assert not empty.any() or not np.diff(starts)[empty].any()
        ids, starts = gather(ids, starts, words.indices.to_numpy(), per_chunk)
        ids, starts = gather(ids, starts, chunks.indices.to_numpy(), per_text)
        if not alone.any():
            return ids, starts
        pieces = [ids[starts[i]:starts[i + 1]] for i in range(len(texts))]
        for i in np.flatnonzero(alone):
            pieces[i] = np.array(self.bpe.encode(texts[int(i)].as_py()), np.int32)
        return np.concatenate(pieces), np.concatenate(([0], np.cumsum([len(p) for p in pieces])))


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] of them), start[1], ..."""
    ends = np.cumsum(count)
    if len(ends) == 0 or ends[-1] == 0:
        return np.empty(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(start - (ends - count), count)


def gather(ids, starts, pick, per_row):
    """Rows of ``ids`` (cut at ``starts``) in the order of ``pick``, joined
    ``per_row`` at a time; the joined ids and where each joined row starts."""
    count = np.diff(starts)[pick]
    total = np.concatenate(([0], np.cumsum(count)))
    return ids[ragged(starts[pick], count)], total[np.concatenate(([0], np.cumsum(per_row)))]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    with open(path, encoding="utf-8") as f:
        return Bpe(json.load(f))


@lru_cache(maxsize=2)
def load_batch(path: str) -> BatchBpe:
    return BatchBpe(load(path))


def encode_documents(docs: DataFrame, tokenizer: str, key: Column | None = None,
                     text: Column | None = None) -> DataFrame:
    """``doc_id``, ``ids array<int>`` and ``decoded string`` of every document.
    ``tokenizer`` is the vocabulary file's path on the executors."""

    def run(batches):
        bpe = load_batch(tokenizer)
        for b in (s for b in batches for s in slices(b)):
            ids, starts = bpe.encode(b.column(1))
            rows = [ids[x:y] for x, y in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(rows, pa.list_(pa.int32())),
                 pa.array([bpe.bpe.decode(x.tolist()) for x in rows], pa.string())],
                names=["doc_id", "ids", "decoded"])

    return columns(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, tokenizer: str, key: Column | None = None,
                     text: Column | None = None) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens``, SHA-256 of the ids as decimals
    joined by one space, SHA-256 of the decoded text.  The same encoder and
    decoder, digested where they run, so no id list leaves the task."""

    def run(batches):
        bpe = load_batch(tokenizer)
        top = max(bpe.bpe.tokens) + 1
        decimal = pa.array([f"{i} " for i in range(top)], pa.large_string())
        token = pa.array([bpe.bpe.tokens.get(i, "") + " " for i in range(top)], pa.large_string())
        for b in (s for b in batches for s in slices(b)):
            ids, starts = bpe.encode(b.column(1))
            out: list[list[str]] = [[], []]
            for x in range(0, b.num_rows, 500):      # strings of a few documents at a time
                cut = starts[x:x + 501]
                here = pa.array(ids[cut[0]:cut[-1]])
                for table, to in zip((decimal, token), out):
                    joined = table.take(here)
                    at = np.frombuffer(joined.buffers()[1], np.int64) if len(joined) else np.zeros(1, np.int64)
                    data = memoryview(joined.buffers()[2] or b"")
                    at = at[cut - cut[0]]
                    to += [hashlib.sha256(data[p:max(p, q - 1)]).hexdigest() for p, q in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(starts)), pa.array(out[0], pa.string()), pa.array(out[1], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return columns(docs, key, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

