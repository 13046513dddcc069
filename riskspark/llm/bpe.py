"""Operator 2: byte-level BPE encoding and decoding by corpus-level merge replay.

The words of a slice of the corpus (the distinct matches of the split pattern) are laid out as one
array of symbols. An inverted index leads from each token pair (by its rank) to the word positions
where it stands; merges are applied in rank order to all words at once, and only the two neighbours of
a merged pair are looked up again and enter the index. Documents are then looked up word by word, so
the replay costs by distinct words; a worker remembers up to KNOWN_WORDS of them for its later slices.
Words are independent, so neither the slicing nor the memory changes a result.

Null text is empty and gives no ids. Repeated rows are encoded each; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import Numbered, ragged, slices, table, with_column

NONE = np.int32(2**31 - 1)
BAND = 512  # ranks that are taken out of the inverted index together
PLACES = 1 << 18  # pieces of texts that are looked up together
KNOWN_WORDS = 100_000  # words (of at most KNOWN_CHARS characters) that a worker remembers, some 25 MB
KNOWN_CHARS = 64
ENCODE_CHARS = 2_000_000  # characters whose words are replayed together


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Merges:
    """Ranks as lookup tables: token ids are ranks; every split of a token into two tokens is a pair."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            self.tokens[r] = token
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, NONE where they do not merge (a negative symbol ends a word)."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[i] == key) & (a >= 0) & (b >= 0), self.values[i], NONE)

    def one_word(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first, for one word."""
        parts = [word[i:i + 1] for i in range(len(word))]
        while True:
            best, at = min(((self.ranks.get(a + b, NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(NONE, 0))
            if best == NONE:
                return [self.ranks[p] for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each word)."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lens + 1)  # where the mark behind each word stands
        size = int(ends[-1]) + 1 if len(words) else 1
        sym = np.full(size, -1, np.int32)
        letter = np.ones(size, bool)
        letter[0] = False
        letter[ends] = False
        sym[letter] = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        nxt = np.arange(1, size + 1, dtype=np.int32)
        prv = np.arange(-1, size - 1, dtype=np.int32)
        nxt[-1] = size - 1
        pair = np.full(size, NONE, np.int32)  # rank of the pair that starts here
        pair[:-1] = self.rank(sym[:-1], sym[1:])
        at = np.flatnonzero(pair != NONE)
        later = [(pair[at], at)]  # the inverted index, ranks and positions, of the bands of ranks to come
        again: list[int] = []
        single: list[tuple[int, int]] = []
        for low in range(0, len(self.tokens), BAND):
            ranks, at = (np.concatenate(x) for x in zip(*later))
            here = ranks < low + BAND
            later = [(ranks[~here], at[~here])]
            ranks, at = ranks[here], at[here]
            at = at[np.argsort(ranks, kind="stable")]
            held = np.bincount(ranks - low, minlength=BAND)
            bounds = np.concatenate([[0], np.cumsum(held)]).tolist()
            added: dict[int, list[int]] = defaultdict(list)  # positions that merges of this band add to it
            todo = (np.flatnonzero(held) + low).tolist()  # ranks that occur, a heap: rising at first
            while todo:
                r = heapq.heappop(todo)
                p = at[bounds[r - low]:bounds[r - low + 1]]
                if r in added:
                    p = np.concatenate([p, np.array(added.pop(r), p.dtype)])
                p = p[pair[p] == r]
                if not len(p):
                    continue
                if len(p) > 1:
                    p = np.sort(p)
                    p = p[np.concatenate([[True], p[1:] != p[:-1]])]
                    tied = nxt[p[:-1]] == p[1:]
                    if tied.any():  # in a run of overlapping pairs every other one merges, from the left
                        index = np.arange(len(p))
                        first = np.maximum.accumulate(np.where(np.concatenate([[True], ~tied]), index, 0))
                        p = p[(index - first) % 2 == 0]
                dead = nxt[p]
                after = nxt[dead]
                near = np.flatnonzero(after[:-1] == p[1:]) + 1  # pairs right behind another merged pair: the first merge
                if len(near):  # by itself would make a pair with their left symbol
                    early = self.rank(np.full(len(near), r, np.int32), sym[p[near]]) < r
                    again.extend(p[near[early]].tolist())
                sym[p] = r
                sym[dead] = -2
                pair[dead] = NONE
                nxt[p] = after
                prv[after] = p
                where = np.concatenate([prv[p], p])
                new = np.full(len(p), r, np.int32)
                found = self.rank(np.concatenate([sym[where[: len(p)]], new]), np.concatenate([new, sym[after]]))
                pair[where] = found
                if len(found) > 8:  # the index of later bands takes arrays
                    over = found >= low + BAND
                    keep = over & (found != NONE)
                    later.append((found[keep], where[keep]))
                    found, where = found[~over], where[~over]
                for k, x in zip(found.tolist(), where.tolist()):
                    if k < r:
                        again.append(x)
                    elif k < low + BAND:
                        if k not in added:
                            heapq.heappush(todo, k)
                        added[k].append(x)
                    elif k != NONE:
                        single.append((k, x))
            if single:
                later.append((np.array([k for k, _ in single], ranks.dtype), np.array([x for _, x in single], at.dtype)))
                single.clear()
        counts = np.diff(np.concatenate([[0], np.cumsum(sym >= 0)[ends]])) if len(words) else np.zeros(0, np.int64)
        flat = sym[sym >= 0]
        if again:  # a merge made a pair of lower rank, which a word by itself takes at once: such words one by one
            redo = np.unique(np.searchsorted(ends, np.array(again)))
            parts = np.split(flat, np.cumsum(counts)[:-1])
            for w in redo.tolist():
                parts[w] = np.array(self.one_word(words[w]), np.int32)
                counts[w] = len(parts[w])
            flat = np.concatenate(parts)
        return flat, counts

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As replay(); a word that is a token itself is that token."""
        whole = [self.ranks.get(w, -1) if w else -2 for w in words]
        rest = [i for i, r in enumerate(whole) if r == -1]
        flat, counts = self.replay([words[i] for i in rest])
        n = np.array([r >= 0 for r in whole], np.int64)
        n[rest] = counts
        out = np.empty(int(n.sum()), np.int32)
        starts = np.cumsum(n) - n
        ready = [i for i, r in enumerate(whole) if r >= 0]
        out[starts[ready]] = [whole[i] for i in ready]
        out[ragged(starts[rest], counts)] = flat
        return out, n


class Remembered:
    """An encoder of words that asks ``encode`` only for those it has not met yet. It remembers at most ``most`` words,
    the first ones of at most ``longest`` characters; the others are encoded each time."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = KNOWN_WORDS, longest: int = KNOWN_CHARS):
        self.encode, self.most, self.longest = encode, most, longest
        self.index: dict[str, int] = {}
        self.flat, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        get = self.index.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        fresh = [words[i] for i in new.tolist()]
        flat, counts = self.encode(fresh) if fresh else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        at[new] = len(self.counts) + np.arange(len(new))
        both, sizes = np.concatenate([self.flat, flat]), np.concatenate([self.counts, counts])
        starts = np.cumsum(sizes) - sizes
        out = both[ragged(starts[at], sizes[at])], sizes[at]
        if fresh and len(self.index) < self.most:
            short = [i for i, w in enumerate(fresh) if len(w) <= self.longest][: self.most - len(self.index)]
            kept = np.array(short, np.int64)
            own = np.cumsum(counts) - counts
            self.index.update(zip((fresh[i] for i in short), range(len(self.counts), len(self.counts) + len(short))))
            self.flat = np.concatenate([self.flat, flat[ragged(own[kept], counts[kept])]])
            self.counts = np.concatenate([self.counts, counts[kept]])
        return out


def _splits(text: str) -> bool:
    """Whether a text holds only single spaces and line ends, each between two other characters."""
    return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
                or len(text.split()) != text.count(" ") + text.count("\n") + 1)  # then other white space stands between words


def _strings(column: pa.LargeStringArray) -> list[str]:
    ends = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8).tolist() if len(column) else [0]
    data = column.buffers()[2].to_pybytes() if len(column) else b""
    return [data[a:b].decode() for a, b in zip(ends, ends[1:])]


def split_pieces(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct pieces, number of the piece at each place, places of each text). Texts are cut at the borders where no
    match of the pattern can cross: before a space or around a line end that stands alone between two other characters.
    Other texts are one piece."""
    whole, single = Numbered(), [i for i, t in enumerate(texts) if t and not _splits(t)]
    numbers = np.array([whole[texts[i]] for i in single], np.int64)
    lens = np.zeros(len(texts), np.int64)
    lens[single] = 1
    cut = np.flatnonzero((lens == 0) & np.fromiter(map(bool, texts), bool, len(texts)))
    lines = pc.replace_substring(pa.array([texts[i] for i in cut.tolist()], pa.large_string()), pattern="\n", replacement=" \n ")
    words = pc.split_pattern(lines, pattern=" ")
    lens[cut] = pc.list_value_length(words).to_numpy()
    coded = words.flatten().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    line_end = code == pc.index(coded.dictionary, pa.scalar("\n", pa.large_string())).as_py()
    plain = line_end.copy()  # the others follow a space
    plain[(np.cumsum(lens[cut]) - lens[cut])] = True
    plain[1:] |= line_end[:-1]
    code = 2 * code + plain
    used = np.flatnonzero(np.bincount(code, minlength=1))
    place = np.zeros(int(used[-1]) + 1 if len(code) else 1, np.int64)
    place[used] = np.arange(len(used))
    spelled = _strings(coded.dictionary)
    pieces = [spelled[c >> 1] if c & 1 else " " + spelled[c >> 1] for c in used.tolist()] if len(code) else []
    if not single:
        return pieces, place[code], lens
    at, starts = np.empty(int(lens.sum()), np.int64), np.cumsum(lens) - lens
    at[ragged(starts[cut], lens[cut])] = place[code]
    at[starts[single]] = len(pieces) + numbers
    return [*pieces, *whole], at, lens


def encode_slice(texts: list[str], words_of, encode_words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other and the number of ids of each text. ``words_of(piece)`` lists
    the words of a piece; ``encode_words(words)`` gives their flat ids and counts."""
    pieces, at, places = split_pieces(texts)
    index = Numbered()
    spelled = [[index[p]] if p[p[0] == " ":].isalpha() else [index[w] for w in words_of(p)] for p in pieces]
    flat, counts = encode_words(list(index))
    starts = np.cumsum(counts) - counts
    lens = np.fromiter(map(len, spelled), np.int64, len(spelled))
    word = np.fromiter((w for ws in spelled for w in ws), np.int64, int(lens.sum()))
    piece_flat = flat[ragged(starts[word], counts[word])]
    piece_word = np.repeat(np.arange(len(pieces)), lens)
    piece_n = np.bincount(piece_word, weights=counts[word], minlength=len(pieces)).astype(np.int64)
    piece_start = np.cumsum(piece_n) - piece_n
    n = piece_n[at]
    ids = [piece_flat[ragged(piece_start[at[i:i + PLACES]], n[i:i + PLACES])] for i in range(0, len(at), PLACES)]
    total = np.concatenate([[0], np.cumsum(n)])
    ends = np.cumsum(places)
    return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), total[ends] - total[ends - places]


_READY: dict[tuple, tuple] = {}  # per worker process: the tables made from the broadcast ranks


def _tools(shared, pattern: str):
    import regex

    key = (id(shared), pattern)
    if key not in _READY:
        _READY.clear()
        merges = Merges({base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())})
        _READY[key] = (shared, Remembered(lambda words: merges.encode_words([w.encode() for w in words])), regex.compile(pattern).findall)
    return _READY[key][1:]


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with ``ids`` (array of int): the ids of the whole text. The rank file (its size is fixed) is
    broadcast as it is; a column of the name ``ids`` is replaced."""
    with open(ranks_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    df = df.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_words, findall = _tools(shared, pattern)
        for rows, texts in slices(batches, text, ENCODE_CHARS):
            flat, sizes = encode_slice(texts, findall, encode_words)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            yield from rows.append_column(ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))).combine_chunks().to_batches()

    return df.mapInArrow(run, with_column(df, ids, "array<int>"))


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with ``decoded`` (binary): the bytes that the ids stand for; null ids give no bytes."""
    with open(ranks_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    df = df.drop(decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, shared.value.splitlines())}
        tokens = pa.array([ranks.get(i) for i in range(max(ranks) + 1)], pa.binary())
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            spelled = tokens.take(lists.flatten())  # all documents' tokens one after the other
            if spelled.null_count:
                raise ValueError("an id that is no token")
            ends = np.frombuffer(spelled.buffers()[1], np.int32, len(spelled) + 1, spelled.offset * 4) if len(spelled) else np.zeros(1, np.int32)
            offsets = ends[np.concatenate([[0], np.cumsum(sizes)])]
            data = spelled.buffers()[2] if len(spelled) else pa.py_buffer(b"")
            out = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets.astype(np.int32)), data])
            yield from pa.Table.from_batches([batch]).append_column(decoded, out).to_batches()

    return df.mapInArrow(run, with_column(df, decoded, "binary"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 of the whole text."""
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode(docs, path, P.PATTERN).drop("text")
    return decode(coded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


QUERIES = {"op2_byte_bpe": op2_byte_bpe}
