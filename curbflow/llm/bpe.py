"""Byte-level BPE encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a batch form a trie, laid out as the sorted words: the words below a node are neighbours, and a
depth-first walk goes from each word to the next after dropping what they don't share. At every node the walk keeps one
state, the last token of the encoding of the path to it. A token can follow another exactly if no merge would cross
their border, so the last token of a longer prefix follows from the states above it, and what words share is encoded
once. A word's tokens are read off by following last tokens upwards.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import filterfalse, islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.llm.tables import extended, free_name, table, text_of

#: White space of the word pattern (Unicode's White_Space).
SPACE = r"\t-\r \x85\xa0  -     　"
#: The word pattern of this tokenizer family.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^%s\p{L}\p{N}]+|[%s]+(?![^%s])|[%s]+" % ((SPACE,) * 4)
)
#: Single spaces and line ends between other characters: words never reach over them, so chunks can be cut there. A
#: space goes with the cut, a line end begins the chunk after it.
CUT = re.compile(r"(?<=\S) (?=\S)|(?<=\S)(?=\n\S)")
TWO_SPACES = re.compile(r"\s\s")
#: Marks after a word: a run of them is a word of its own.
MARKS = ".,;:!?%$*#&|<>"
#: Chunks of a generation that a task remembers, and remembered pairs of neighbours. A full generation becomes the old
#: one; what is used again moves over from there before it is dropped.
REMEMBERED = 350_000
PAIRS = 300_000
#: Last bytes of a path by which the tokens it can end in are remembered.
TAIL = 5
NEVER = 1 << 60


def byte_of_char() -> dict[str, int]:
    """The tokenizer family's printable stand-ins for bytes: printable Latin-1 stands for itself, the rest in order
    from code point 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and added tokens of a tokenizer file (byte-level BPE, JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = byte_of_char()
        model = spec["model"]
        self.bytes_of: dict[int, bytes] = {i: bytes(byte[c] for c in t) for t, i in model["vocab"].items() if all(c in byte for c in t)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode()
        self.id_of = {b: i for i, b in self.bytes_of.items() if i not in self.added.values()}
        self.longer: dict[bytes, list[int]] = {}  # lengths of the tokens that end in so many bytes and more, downwards
        for b in sorted(self.id_of, key=len, reverse=True):
            own = self.longer.setdefault(b[-TAIL:], []) if len(b) > TAIL else [len(b)]
            if len(b) not in own:
                own.append(len(b))
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = (model["vocab"][left], model["vocab"][right])
            self.rank.setdefault(pair, rank)
            self.parts.setdefault(model["vocab"][left + right], pair)
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=-1) + 1)]
        self.splitter = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self._follows: dict[int, bool] = {}
        self._edge: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._whole: dict[int, bool] = {}
        self._endings: dict[bytes, list[tuple[int, int]]] = {}

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at one side of `token` while it is built up, each with the rank of the merge that
        swallows it (never, for the token itself)."""
        found = self._edge.get((token, side))
        if found is None:
            found, end = [(token, NEVER)], token
            while end in self.parts:
                whole, end = end, self.parts[end][side]
                found.append((end, self.rank[self.parts[whole]]))
            self._edge[token, side] = found
        return found

    def follows(self, a: int, b: int) -> bool:
        """Whether b can stand after a: no merge crosses their border while both are built up. A crossing merge
        happens if it ranks before the merge that swallows its left part, and not after the one that swallows its
        right part, as of equal merges the leftmost goes first."""
        key = a << 32 | b
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) > PAIRS:
                self._follows.clear()
            ends, known = self.edge(b, 0), True
            for x, until_x in self.edge(a, 1):
                for y, until_y in ends:
                    r = self.rank.get((x, y))
                    if r is not None and r < until_x and r <= until_y:
                        known = False
            self._follows[key] = known
        return known

    def is_whole(self, token: int) -> bool:
        """Whether the token's own bytes encode to it alone."""
        known = self._whole.get(token)
        if known is None:
            pair = self.parts.get(token)
            if pair is None:
                known = len(self.bytes_of[token]) == 1
            else:
                r = self.rank[pair]
                known = self.is_whole(pair[0]) and self.is_whole(pair[1]) and all(
                    not ((q := self.rank.get((x, y))) is not None and q < min(until_x, r) and q <= min(until_y, r) and q != r)
                    for x, until_x in self.edge(pair[0], 1) for y, until_y in self.edge(pair[1], 0)
                )
            self._whole[token] = known
        return known

    def endings(self, tail: bytes) -> list[tuple[int, int]]:
        """(length, token) of the tokens that a path with these last bytes can end in, the longest first; -1 for
        those longer than the tail, which the path may have or not."""
        if len(self._endings) > PAIRS:
            self._endings.clear()
        found = [(n, -1) for n in self.longer.get(tail, ())] if len(tail) == TAIL else []
        found += [(n, token) for n in range(len(tail), 0, -1) if (token := self.id_of.get(tail[-n:])) is not None]
        self._endings[tail] = found
        return found

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, tuple[int, ...]]:
        """The tokens of each word, by one depth-first walk over the trie of all of them."""
        out: dict[bytes, tuple[int, ...]] = {}
        ordered, before = sorted(words), b""
        longest = max(map(len, ordered), default=0)
        last = [-1] * (longest + 1)  # last[i]: last token of the first i bytes of the path
        size = [0] * (longest + 1)
        id_of, known, ends_in, whole = self.id_of.get, self._follows.get, self._endings.get, self._whole.get
        for word in ordered:
            shared, least = 0, min(len(word), len(before))
            if word[:least] == before[:least]:
                shared = least
            else:
                while word[shared] == before[shared]:
                    shared += 1
            for end in range(shared + 1, len(word) + 1):
                tail = word[end - TAIL : end] if end > TAIL else word[:end]
                for n, token in ends_in(tail) or self.endings(tail):
                    if token < 0 and (n > end or (token := id_of(word[end - n : end], -1)) < 0):
                        continue
                    if n == end:
                        if (fits := whole(token)) is None:
                            fits = self.is_whole(token)
                    elif (fits := known(last[end - n] << 32 | token)) is None:
                        fits = self.follows(last[end - n], token)
                    if fits:
                        last[end], size[end] = token, n
                        break
                else:
                    raise ValueError(f"the vocabulary lacks byte {word[end - 1]}")
            tokens, at = [], len(word)
            while at:
                tokens.append(last[at])
                at -= size[at]
            out[word] = tuple(tokens[::-1])
            before = word
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker."""
    return Vocabulary(path)


class Encoder:
    """Encodes batches of whole texts. What it remembers are the ids of a chunk as the bytes of 32-bit integers."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.first: dict[str, bytes] = {}  # chunks at the start of a text or a line
        self.spaced: dict[str, bytes] = {}  # chunks after a space, without it, and after a line end, with it
        self.old: dict[str, bytes] = {}  # the generation before, of `spaced`

    def pieces(self, text: str) -> list[str | int]:
        """Texts between added tokens, and the ids of those."""
        if self.vocab.splitter is None or not any(t in text for t in self.vocab.added):
            return [text]
        return [self.vocab.added.get(p, p) for p in self.vocab.splitter.split(text) if p]

    @staticmethod
    def chunks(piece: str) -> list[str]:
        if TWO_SPACES.search(piece) or piece[:1].isspace() or piece[-1:].isspace():
            return CUT.split(piece)
        return piece.replace("\n", " \n").split(" ")

    def learn(self, known: dict[str, bytes], lead: str, chunks: Iterable[str]) -> None:
        """Encode chunks that are not remembered, all words of them in one trie."""
        words_of: dict[str, list[bytes]] = {}
        marked: list[tuple[str, str, bytes]] = []
        marks: set[bytes] = set()
        for c in chunks:
            stem = c.rstrip(MARKS)
            if not stem.isalpha():
                words_of[c] = [w.encode("utf-8", "surrogatepass") for w in WORDS.findall(lead + c)]
                continue
            if stem not in known and stem not in words_of:
                words_of[stem] = [(lead + stem).encode()]
            if len(stem) < len(c):  # a word and the marks after it, which are a word of their own
                after = c[len(stem) :].encode()
                marked.append((c, stem, after))
                marks.add(after)
        ids = self.vocab.encode_words(marks.union(*words_of.values()))
        raw = {word: pack(f"={len(found)}i", *found) for word, found in ids.items()}
        for chunk, words in words_of.items():
            known[chunk] = raw[words[0]] if len(words) == 1 else b"".join(map(raw.__getitem__, words))
        for chunk, stem, after in marked:
            known[chunk] = known[stem] + raw[after]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.first) + len(self.spaced) > REMEMBERED:
            self.old, self.first, self.spaced = self.spaced, {}, {}
        cut = [[p if isinstance(p, int) else self.chunks(p) for p in self.pieces(t)] for t in texts]
        heads: set[str] = set()
        tails: set[str] = set()
        for parts in cut:
            for p in parts:
                if not isinstance(p, int):
                    heads.add(p[0])
                    tails.update(filterfalse(self.spaced.__contains__, islice(p, 1, None)))
        again = tails & self.old.keys()
        self.spaced.update((c, self.old[c]) for c in again)
        tails -= again
        lines = {c for c in tails if c[:1] == "\n"}
        heads.update(c[1:] for c in lines)
        self.learn(self.first, "", [c for c in {*heads, "\n"} if c not in self.first])
        self.spaced.update((c, self.first["\n"] + self.first[c[1:]]) for c in lines)
        self.learn(self.spaced, " ", tails - lines)
        spaced = self.spaced.__getitem__
        out = []
        for parts in cut:
            found: list[bytes] = []
            for p in parts:
                if isinstance(p, int):
                    found.append(pack("=i", p))
                else:
                    found.append(self.first[p[0]])
                    found += map(spaced, islice(p, 1, None))
            out.append(np.frombuffer(b"".join(found), np.int32))
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per Python worker: later tasks of a worker find the chunks of earlier ones, in two bounded generations."""
    return Encoder(vocabulary(path))


#: Characters of texts encoded at a time: bounds the words held, whatever the rows of an Arrow batch hold.
GROUP = 2_000_000


def _encoded_groups(batches: Iterator[pa.RecordBatch], path: str, passed: int) -> Iterator[tuple[list[pa.Array], list[np.ndarray]]]:
    """The first `passed` columns and the token ids of the text column after them, group by group."""
    texts_to_ids = encoder(path).encode
    for batch in batches:
        start, chars, texts = 0, 0, []
        for k, value in enumerate(batch.column(passed)):
            texts.append(value.as_py())
            chars += len(texts[-1])
            if chars >= GROUP or k + 1 == batch.num_rows:
                yield [c.slice(start, len(texts)) for c in batch.columns[:passed]], texts_to_ids(texts)
                start, chars, texts = k + 1, 0, []


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))


def encoded(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with `ids`, the token ids of every whole text. Null and empty texts have none.

    Added tokens of the file that occur in a text become their ids. path: the tokenizer file, readable on every
    executor. Rows that repeat are encoded each for itself; no rows give no rows. If `keep` has a column `ids`, the new
    one gets underscores in front."""
    kept = docs.select(*keep)
    name = free_name(kept, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, ids in _encoded_groups(batches, path, len(keep)):
            yield pa.RecordBatch.from_arrays([*columns, _lists(ids)], names=[*keep, name])

    return docs.select(*keep, text_of(text_col).alias("_text")).mapInArrow(run, extended(kept, f"`{name}` array<int>"))


def text_of_ids(ids: list[int], tokens: list[bytes]) -> str:
    """The bytes of the tokens as text. Bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
    try:
        raw = b"".join(map(tokens.__getitem__, ids))
    except IndexError:
        raw = b"".join(tokens[i] for i in ids if i < len(tokens))
    return raw.decode("utf-8", "replace")


def decoded(tokens: DataFrame, path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id", "ids")) -> DataFrame:
    """The columns `keep` with `decoded`, the text of the ids; added tokens stay. Null ids give an empty text. If
    `keep` has a column `decoded`, the new one gets underscores in front."""
    kept = tokens.select(*keep)
    name = free_name(kept, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path).table
        for batch in batches:
            texts = [text_of_ids(value.as_py() or [], known) for value in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, name])

    return tokens.select(*keep, F.col(ids_col).alias("_ids")).mapInArrow(run, extended(kept, f"`{name}` string"))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` with `ids` and `decoded`, as `encoded` and `decoded` give them, with one Python worker for
    both in each task. If `keep` has columns of these names, the new ones get underscores in front. Rows that repeat are
    taken each for itself; no rows give no rows."""
    kept = docs.select(*keep)
    ids_name, text_name = free_name(kept, "ids"), free_name(kept, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path).table
        for columns, ids in _encoded_groups(batches, path, len(keep)):
            texts = pa.array([text_of_ids(i.tolist(), known) for i in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, _lists(ids), texts], names=[*keep, ids_name, text_name])

    rows = docs.select(*keep, text_of(text_col).alias("_text"))
    return rows.mapInArrow(run, extended(kept, f"`{ids_name}` array<int>, `{text_name}` string"))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    path = path or default_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
