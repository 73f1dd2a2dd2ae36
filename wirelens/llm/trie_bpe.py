"""Byte-pair encoding and decoding by a prefix-sharing trie of distinct words.

Byte-pair encoding has one last token for every prefix of a word: the only token that ends the prefix, and that the
merges keep apart from the last token of what stands before it. So a word's encoding is known from the states (last
token, where it begins) of its prefixes. Each task inserts the distinct words of its texts, in sorted order, into a
trie; a node's state is found once, when a depth-first walk first reaches it, and shared by all words under it. A
word's end is a symbol of its own, as vocabularies with word ends have other tokens there.

Nothing is shuffled and nothing but the vocabulary file, of fixed size, is sent to tasks. Trie and known words are
emptied at set sizes, which costs time, never results. A very long word is walked as one branch, in arrays.

A null text is empty; empty texts have no identifiers; repeated rows are encoded each; an empty table gives an
empty result; further columns of other names stay behind.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices

#: Symbols of a word: byte values, plus this for the byte that ends it.
FINAL = 256
#: Trie nodes, known runs and pairs of tokens that a task keeps (some 350 MB together).
MOST_NODES, MOST_RUNS, MOST_PAIRS = 1_000_000, 500_000, 500_000
#: Words and runs of more characters aren't kept.
LONG_WORD = 256
#: Characters of a text that are cut into runs at once.
PIECE_CHARS = 1 << 18
#: Characters of blocks that every Unicode version since 6 treats alike; what holds others is split by the library.
_UNSETTLED = re.compile("[^\x00-\u0557\u2000-\u2027\u202a-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]")
#: Controls that end a word in Python but aren't white space by Unicode.
_NO_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte: itself where it is printable Latin-1,
    else the next free one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256))
    return [chr(b) if b in shown else chr(256 + next(spare)) for b in range(256)]


class Vocabulary:
    """What a tokenizer file says: special strings, patterns, tokens as symbol strings, and merges."""

    def __init__(self, definition: str):
        told = json.loads(definition)
        model, letters = told["model"], byte_letters()
        kinds = [x["type"] for x in told["normalizer"]["normalizers"]] + [x["type"] for x in told["pre_tokenizer"]["pretokenizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] or not model["end_of_word_suffix"] or told["decoder"] is not None:
            raise ValueError("not a lower-case byte-level vocabulary with word ends")
        self.definition = definition
        self.specials = {x["content"]: x["id"] for x in told["added_tokens"]}
        self.pattern = told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        #: A token's text by id, for decoding.
        self.text = {i: t for t, i in ids.items()} | {i: t for t, i in self.specials.items()}
        #: Tokens that are one symbol, by symbol.
        self.single = [ids[c] for c in letters] + [ids[c + end] for c in letters]
        #: Symbol strings of tokens.
        self.token = {chr(i): t for i, t in enumerate(self.single)}
        #: The merge that makes a token: (rank, left, right).
        self.made: dict[int, tuple[int, int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        spelled = {t: s for s, t in self.token.items()}
        for rank, (a, b) in enumerate(x.split(" ") if isinstance(x, str) else x for x in model["merges"]):
            left, right, whole = ids[a], ids[b], ids[a + b]
            self.made[whole] = (rank, left, right)
            self.rank[left, right] = rank
            spelled[whole] = spelled[left] + spelled[right]
            self.token[spelled[whole]] = whole
        self._endings()
        self._edges: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}

    def _endings(self) -> None:
        """An automaton over the tokens' symbols: ``ends`` has, for the longest end of a text that begins a token, the
        tokens that end there as (token, length), longest first; ``step`` moves on by a symbol."""
        self.follow: dict[int, int] = {}
        self.ends, token_at, fall = [()], {}, [0]
        depths: list[list[tuple[int, int, int]]] = []
        for spelling, token in self.token.items():
            at = 0
            for depth, symbol in enumerate(map(ord, spelling)):
                key = at << 9 | symbol
                if key not in self.follow:
                    self.follow[key] = len(fall)
                    while len(depths) <= depth:
                        depths.append([])
                    depths[depth].append((at, symbol, len(fall)))
                    fall.append(0)
                    self.ends.append(())
                at = self.follow[key]
            token_at[at] = (token, len(spelling))
        self._fall = fall
        for level in depths:
            for parent, symbol, at in level:
                fall[at] = self.step(fall[parent], symbol) if parent else 0
                self.ends[at] = ((token_at[at],) if at in token_at else ()) + self.ends[fall[at]]

    def step(self, at: int, symbol: int) -> int:
        while (found := self.follow.get(at << 9 | symbol)) is None:
            if not at:
                return 0
            at = self._fall[at]
        return found

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at a token's left (0) or right (1) edge while it is built, each with the rank of the merge
        that takes it up."""
        known = self._edges[side].get(token)
        if known is None:
            known, at, until = [], token, float("inf")
            while True:
                known.append((at, until))
                if at not in self.made:
                    break
                until, *halves = self.made[at]
                at = halves[side]
            self._edges[side][token] = known = known[::-1]
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' symbols gives these two tokens: no pair that ever meets at their border is
        merged before one of it is taken up on its own side. At equal ranks the pair further left goes first."""
        known = self.pairs.get(left << 20 | right)
        if known is None:
            ends, begins = self._edge(left, 1), self._edge(right, 0)
            i = j = 0
            known = True
            while True:
                (a, a_until), (b, b_until) = ends[i], begins[j]
                rank = self.rank.get((a, b))
                if rank is not None and rank < a_until and rank <= b_until:
                    known = False
                    break
                if a_until == b_until == float("inf"):
                    break
                if a_until <= b_until:
                    i += 1
                if b_until <= a_until:
                    j += 1
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            self.pairs[left << 20 | right] = known
        return known


class Trie:
    """Prefixes of words with their states. Node 0 is the empty prefix."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.child: dict[int, int] = {}
        #: Of each node: its prefix's last token, the node where that token begins, and the automaton's place.
        self.last, self.begin, self.place = [-1], [0], [0]

    def __len__(self) -> int:
        return len(self.last)

    def insert(self, word: str, path: list[int], at: int) -> list[int]:
        """The word's encoding; states are found for the prefixes that no word before had. ``path`` holds the nodes of
        the prefixes of the word inserted before, the first ``at`` symbols of which are this word's too."""
        child, last, begin, place = self.child, self.last, self.begin, self.place
        follow, ends, pairs = self.vocabulary.follow, self.vocabulary.ends, self.vocabulary.pairs
        del path[at + 1 :]
        node = path[at]
        for n, symbol in enumerate(map(ord, word[at:]), at + 1):
            key = node << 9 | symbol
            found = child.get(key)
            if found is None:
                reached = follow.get(place[node] << 9 | symbol)
                if reached is None:
                    reached = self.vocabulary.step(place[node], symbol)
                for token, size in ends[reached]:
                    start = path[n - size]
                    if not start:
                        break
                    apart = pairs.get(last[start] << 20 | token)
                    if self.vocabulary.apart(last[start], token) if apart is None else apart:
                        break
                else:
                    raise ValueError("no token ends here")
                found = child[key] = len(last)
                last.append(token)
                begin.append(start)
                place.append(reached)
            path.append(found)
            node = found
        out = []
        while node:
            out.append(last[node])
            node = begin[node]
        return out[::-1]


def shared_prefix(a: str, b: str) -> int:
    most = min(len(a), len(b))
    for n in range(most):
        if a[n] != b[n]:
            return n
    return most


class Encoder:
    """Texts to identifiers; keeps a trie of the words, and the runs between white space, that it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.trie = Trie(vocabulary)
        #: Identifiers of runs as little-endian 32-bit integers; what was met last, and what was met before that.
        self.runs: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.specials, key=len, reverse=True))) + ")") if vocabulary.specials else None
        self.words = regex.compile(vocabulary.pattern).findall
        self._library = None

    def split(self, run: str) -> list[str]:
        """The words of a run without white space or special strings: composed, in lower case, cut by the vocabulary's
        pattern. A capital sigma becomes the plain small one wherever it stands."""
        if run.isascii():
            return self.words(run.lower())
        if _UNSETTLED.search(run) is None:
            return self.words(unicodedata.normalize("NFC", run).replace("\u03a3", "\u03c3").lower())
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.vocabulary.definition)
            self._bytes = {c: b for b, c in enumerate(byte_letters())}
        normal = self._library.normalizer.normalize_str(run)
        return [bytes(map(self._bytes.__getitem__, w)).decode() for w, _ in self._library.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Lists of the runs of a text, a piece of it at a time; special strings are runs of their own."""
        for part in self.special.split(text) if self.special and "<" in text else [text]:
            at = 0
            while at < len(part):
                end = len(part)
                if end - at > PIECE_CHARS and (found := _SPACE.search(part, at + PIECE_CHARS)):
                    end = found.start()
                piece = part[at:end]
                yield [x for x in _SPACE.split(piece) if x] if _NO_SPACE.search(piece) else piece.split()
                at = end

    def learn(self, runs: set[str]) -> None:
        """Encode what isn't known of ``runs``. The distinct words enter the trie in sorted order, which walks it depth
        first: a word goes on from where it leaves the one before."""
        if len(self.trie) > MOST_NODES:
            self.trie = Trie(self.vocabulary)
        if len(self.runs) > MOST_RUNS // 2:
            self.runs, self.older = {}, self.runs
        split = {}
        for run in runs.difference(self.runs):
            if (known := self.older.get(run)) is not None:
                self.runs[run] = known
            elif run in self.vocabulary.specials:
                self.runs[run] = array("I", [self.vocabulary.specials[run]]).tobytes()
            else:
                split[run] = self.split(run)
        symbols = {}
        for word in {w for words in split.values() for w in words}:
            raw = word.encode()
            symbols[raw[:-1].decode("latin-1") + chr(FINAL + raw[-1])] = word
        coded, before, path = {}, "", [0]
        for spelled in sorted(symbols):
            if len(spelled) > LONG_WORD:
                ids = Trie(self.vocabulary).insert(spelled, [0], 0)
            else:
                ids = self.trie.insert(spelled, path, shared_prefix(before, spelled))
                before = spelled
            coded[symbols[spelled]] = array("I", ids).tobytes()
        for run, words in split.items():
            self.runs[run] = coded[words[0]] if len(words) == 1 else b"".join([coded[w] for w in words])

    def encode(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """For each text, its identifiers piece by piece. Short texts' runs are learnt together."""
        if sum(map(len, texts)) <= 4 * PIECE_CHARS:
            lists = [list(self.pieces(x)) for x in texts]
            self.learn({run for pieces in lists for piece in pieces for run in piece})
            for pieces in lists:
                yield (b"".join([self.runs[x] for x in piece]) for piece in pieces)
        else:
            for x in texts:
                yield map(self._encoded, self.pieces(x))

    def _encoded(self, piece: list[str]) -> bytes:
        self.learn(set(piece))
        out = b"".join([self.runs[x] for x in piece])
        for run in piece:
            if len(run) > LONG_WORD:
                self.runs.pop(run, None)
        return out

    def decode(self, ids: bytes) -> str:
        """What the identifiers stand for: tokens joined by blanks."""
        return " ".join(map(self.vocabulary.text.__getitem__, array("I", ids)))


@lru_cache(1)
def _encoder(definition: str) -> Encoder:
    """A Python worker's encoder, which its tasks share."""
    return Encoder(Vocabulary(definition))


def load_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file; its size is the file's, whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        return Vocabulary(f.read())


def _broadcast(docs: DataFrame, vocabulary: Vocabulary):
    return docs.sparkSession.sparkContext.broadcast(vocabulary.definition)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, decoded): the identifiers of every whole text and what they decode to."""
    shared = _broadcast(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for part in slices(batches, "text"):
            coded = [b"".join(x) for x in encoder.encode([t or "" for t in part.column("text").to_pylist()])]
            ids = pa.array([array("i", x).tolist() for x in coded], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "ids": ids, "decoded": pa.array(map(encoder.decode, coded), pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` with ``decoded``, the text of their ``ids``: tokens joined by blanks; identifiers that the vocabulary
    hasn't got are left out, null counts as none."""
    known = F.lit([vocabulary.text.get(i) for i in range(max(vocabulary.text) + 1)])
    found = F.filter(F.transform("ids", lambda i: F.get(known, i)), lambda t: t.isNotNull())
    return rows.withColumn("decoded", F.coalesce(F.array_join(found, " "), F.lit("")))


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text; a long text's pieces are digested as they
    come, so it is never held encoded."""
    shared = _broadcast(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for part in slices(batches, "text"):
            counts, ids, decoded = [], [], []
            for pieces in encoder.encode([t or "" for t in part.column("text").to_pylist()]):
                n, a, b = 0, hashlib.sha256(), hashlib.sha256()
                for x in pieces:
                    if x:
                        a.update(x)
                        b.update((" " * bool(n) + encoder.decode(x)).encode())
                        n += len(x) // 4
                counts.append(n)
                ids.append(a.hexdigest())
                decoded.append(b.hexdigest())
            yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
