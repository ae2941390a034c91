"""Byte-pair encoding by speculation and verification, and decoding.

Greedy longest match proposes a token sequence for every distinct word of a batch. A sequence is
what merging would give if and only if no merge would ever cross a border between neighbours, and
that depends on the two neighbours alone. Whether a pair lets its border stand is decided for all
distinct adjacent pairs at once, by walking the merge trees on both sides of the border back in
time; only words with a pair that fails are merged step by step.

The file is a tokenizer description with a byte-level word model and a word-end suffix; its path is
a parameter, and every executor reads it from there. Words that hold only Latin letters and common
signs are cut by one pattern; texts with anything else go through the file's own normaliser
and word pattern, so that their Unicode rules are the library's.

Defined cases: a null text is the empty text, without ids; the strings of special tokens are those
tokens wherever they occur; repeated rows get equal results; an empty table gives an empty result.
Only the text is read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# A word's chunks are kept up to this number, then forgotten; results do not depend on it.
REMEMBERED = 250_000
ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"

_END = "\u0100"  # stands for the word end; byte values take the code points below
_GAP = "\u0101"  # between chunks
_MARK = "\x01"  # the word end in plain text, which holds no control characters
_FOUND = np.dtype([("end", np.int64), ("token", np.int64)])
_TEXTS = 500
_WIDTHS = (8, 16, 32, 64)
_WIDE = _WIDTHS[-1]
_LETTER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u0148\u014a-\u017f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\u012f\\u0131-\\u0148\\u014a-\\u017e\\u2010-\\u2027\\u20ac]")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
_NEVER = np.iinfo(np.int64).max


def byte_letters() -> dict[str, str]:
    """The letter that a byte-level model writes for each byte, to the code point of that byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): chr(b) for b in shown} | {chr(256 + i): chr(b) for i, b in enumerate(hidden)}


_LETTERS = byte_letters()


class WordModel:
    """Vocabulary and merges of one file as arrays: each token's two halves and the rank of their merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.names = [""] * size
        for name, i in [*vocab.items(), *self.special.items()]:
            self.names[i] = name
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        ambiguous = []
        for at, pair in enumerate(model["merges"]):
            one, two = pair.split(" ") if isinstance(pair, str) else pair
            a, b, whole = vocab[one], vocab[two], vocab[one + two]
            self.merges[a, b] = (at, whole)
            if self.rank[whole] < 0:
                self.left[whole], self.right[whole], self.rank[whole] = a, b, at
            else:
                ambiguous.append(whole)
        letters = _LETTERS
        self.base: dict[str, int] = {}
        for name, i in vocab.items():
            if name in letters:
                self.base[letters[name]] = i
            elif name.endswith(suffix) and name[: -len(suffix)] in letters:
                self.base[letters[name[: -len(suffix)]] + _END] = i
        spelled = {i: s for s, i in self.base.items()}
        for whole in np.argsort(self.rank, kind="stable").tolist():
            if self.rank[whole] >= 0:
                spelled[whole] = spelled[self.left[whole]] + spelled[self.right[whole]]
        keys = np.array([(a << 32) | b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        # A token may be proposed if merging its own bytes gives the token: halves that may be, and a border
        # between them that nothing crosses before their merge.
        self.sound = np.ones(size, bool)
        made = np.flatnonzero(self.rank >= 0)
        stands = self.border_stands(self.left[made], self.right[made], self.rank[made])
        self.sound[made[~stands]] = False
        self.sound[ambiguous] = False
        for whole in made[np.argsort(self.rank[made])].tolist():
            self.sound[whole] &= self.sound[self.left[whole]] and self.sound[self.right[whole]]
        self.made = np.zeros(len(self.merges), np.int64)
        for rank, whole in self.merges.values():
            self.made[rank] = whole
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.width = np.zeros(size, np.int64)
        for i, text in spelled.items():
            self.width[i] = len(text)
            if self.sound[i]:
                self.matcher.add_word(text, i)
        self.matcher.make_automaton()
        self.letter = np.array([self.base[chr(b)] for b in range(256)], np.int64)
        self.last_letter = np.array([self.base[chr(b) + _END] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], _NEVER)

    def border_stands(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | int = _NEVER) -> np.ndarray:
        """Whether no merge of rank below `until` crosses the border between tokens a and b.

        The piece left of the border is at each rank a node on a's right spine, the one right of it on b's
        left spine. A crossing of rank r takes place if both pieces still stand: the left one's parent
        comes after r (at the same rank the parent, further left, comes first), the right one's not before r.
        """
        u, v = a.astype(np.int64), b.astype(np.int64)
        until = np.broadcast_to(np.asarray(until, np.int64), u.shape)
        after_u, after_v = np.full(u.shape, _NEVER), np.full(u.shape, _NEVER)
        stands = np.ones(u.shape, bool)
        live = np.arange(u.size)
        while live.size:
            uu, vv = u[live], v[live]
            r = self.ranks_of(uu, vv)
            stands[live[(r < until[live]) & (r < after_u[live]) & (r <= after_v[live])]] = False
            ru, rv = self.rank[uu], self.rank[vv]
            back_u = (ru >= rv) & (ru >= 0)
            back_v = (rv > ru) & (rv >= 0)
            at_u, at_v = live[back_u], live[back_v]
            after_u[at_u], u[at_u] = ru[back_u], self.right[uu[back_u]]
            after_v[at_v], v[at_v] = rv[back_v], self.left[vv[back_v]]
            live = live[(back_u | back_v) & stands[live]]
        return stands

    def propose(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match over joined words: tokens and where each ends. No token reaches past a word end."""
        found = np.fromiter(self.matcher.iter_long(joined), _FOUND)
        return found["token"].copy(), found["end"].copy()

    def merge(self, marks: list[int]) -> list[int]:
        """Exact merging of one word's letters: the lowest rank first, of equal ranks the leftmost."""
        ids = list(marks)
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (met := self.merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (met[0], i, ids[i], ids[j], met[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, a, b, whole = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = whole, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [i for i in ids if i >= 0]

    def merge_many(self, letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of words side by side, one merge of every word a round: ids in a row, ids per word."""
        out: list[np.ndarray | None] = [None] * len(sizes)
        starts = np.cumsum(sizes) - sizes
        for at in np.flatnonzero(sizes > _WIDE).tolist():
            out[at] = np.array(self.merge(letters[starts[at]:starts[at] + sizes[at]].tolist()), np.int64)
        for low, high in zip((0, *_WIDTHS), _WIDTHS):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if not len(rows):
                continue
            column = np.arange(high)
            held = column < sizes[rows, None]
            ids = np.where(held, letters[np.where(held, starts[rows, None] + column, 0)], -1)
            after = np.where(column + 1 < sizes[rows, None], column + 1, high) + np.zeros_like(ids)
            before = np.broadcast_to(column - 1, ids.shape).copy()
            ranks = np.full(ids.shape, _NEVER)
            pairs = held[:, 1:]
            ranks[:, :-1][pairs] = self.ranks_of(ids[:, :-1][pairs], ids[:, 1:][pairs])
            live = np.arange(len(rows))
            while len(live):
                at = ranks[live].argmin(axis=1)
                open_ = ranks[live, at] < _NEVER
                live, at = live[open_], at[open_]
                if not len(live):
                    break
                gone = after[live, at]
                ids[live, at] = self.made[ranks[live, at]]
                ids[live, gone] = -1
                ranks[live, gone] = _NEVER
                follow = after[live, gone]
                after[live, at] = follow
                linked = follow < high
                before[live[linked], follow[linked]] = at[linked]
                ranks[live, at] = _NEVER
                ranks[live[linked], at[linked]] = self.ranks_of(ids[live[linked], at[linked]], ids[live[linked], follow[linked]])
                lead = before[live, at]
                led = lead >= 0
                ranks[live[led], lead[led]] = self.ranks_of(ids[live[led], lead[led]], ids[live[led], at[led]])
            for row, merged in zip(rows.tolist(), ids):
                out[row] = merged[merged >= 0]
        flat = np.concatenate([o for o in out if o is not None]) if len(out) else np.array([], np.int64)
        return flat, np.array([len(o) if o is not None else 0 for o in out], np.int64)

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids, as bytes, of distinct chunks: words in byte code points, each followed by the word end.

        Propose, verify every pair of neighbours inside a word, and merge the words that fail.
        """
        joined = _GAP.join(chunks) + _GAP
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
        gaps, word_ends = np.flatnonzero(code == ord(_GAP)), np.flatnonzero(code == ord(_END))
        if not len(word_ends):
            return [b""] * len(chunks)
        chunk_of = np.searchsorted(gaps, word_ends)
        word_starts = np.concatenate([[0], word_ends[:-1] + 1])
        word_starts += code[word_starts] == ord(_GAP)
        empty = np.flatnonzero(code[word_starts] == ord(_GAP))
        while len(empty):  # chunks without words
            word_starts[empty] += 1
            empty = empty[code[word_starts[empty]] == ord(_GAP)]

        tokens, ends = self.propose(joined)
        word_of = np.searchsorted(word_ends, ends)
        covered = np.bincount(word_of, self.width[tokens], len(word_ends)).astype(np.int64)
        fails = covered != word_ends - word_starts + 1
        inner = np.flatnonzero(word_of[:-1] == word_of[1:])
        keys, where = np.unique((tokens[inner] << 32) | tokens[inner + 1], return_inverse=True)
        stands = self.border_stands(keys >> 32, keys & 0xFFFFFFFF)
        fails[word_of[inner[~stands[where]]]] = True

        again = np.flatnonzero(fails)
        sizes = word_ends[again] - word_starts[again]
        total = int(sizes.sum())
        places = np.repeat(word_starts[again] - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)
        letters = self.letter[code[places]]
        letters[np.cumsum(sizes) - 1] = self.last_letter[code[word_ends[again] - 1]]
        merged, counts = self.merge_many(letters, sizes)
        good = ~fails[word_of]
        all_tokens = np.concatenate([tokens[good], merged])
        all_words = np.concatenate([word_of[good], np.repeat(again, counts)])
        order = np.argsort(all_words, kind="stable")
        data = all_tokens[order].astype("<u4").tobytes()
        bounds = np.cumsum(np.bincount(chunk_of[all_words], minlength=len(chunks))).tolist()
        return [data[4 * a:4 * b] for a, b in zip([0, *bounds], bounds)]

    def decode(self, ids: np.ndarray) -> str:
        """Without a decoder in the file the library joins the tokens' names by a space."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _plain_chunks(chunks: list[str]) -> list[str]:
    """Runs without blanks, cut into words in byte code points with the word end after each."""
    marked = _WORDS.sub(r"\g<0>" + _MARK, "\n".join(chunks))
    return marked.encode("utf-8").decode("latin-1").replace(_MARK, _END).split("\n")


@functools.cache
def word_model(path: str) -> WordModel:
    return WordModel(path)


def _library_words(model: WordModel, text: str) -> list[str]:
    normal = model.library.normalizer.normalize_str(text)
    pieces = model.library.pre_tokenizer.pre_tokenize_str(normal)
    return ["".join(map(_LETTERS.__getitem__, piece)) + _END for piece, _ in pieces if piece]


def encode_texts(model: WordModel, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text as the library gives them, special tokens' strings included, nothing added."""
    names = sorted(model.special, key=len, reverse=True)
    special = re.compile("|".join(map(re.escape, names))) if names else None
    if len(model.known) > REMEMBERED:
        model.known.clear()
    known, rows = model.known, []
    plain, others = set(), set()
    for text in texts:
        row: list[str] = []
        rows.append(row)
        at = 0
        for hit in special.finditer(text) if special else ():
            _add(model, text[at:hit.start()], row, plain, others)
            row.append(_MARK + hit[0])
            known[row[-1]] = model.special[hit[0]].to_bytes(4, "little")
            at = hit.end()
        _add(model, text[at:] if at else text, row, plain, others)
    fresh = [chunk for chunk in plain if chunk not in known]
    words = [word for word in others if word not in known]
    if fresh or words:
        spelled = [*(_plain_chunks(fresh) if fresh else ()), *(word[1:] for word in words)]
        known.update(zip([*fresh, *words], model.encode_chunks(spelled)))
    return [np.frombuffer(b"".join(map(known.__getitem__, row)), "<u4") for row in rows]


def _add(model: WordModel, text: str, row: list, plain: set, others: set) -> None:
    """Cut a text without special tokens into chunks whose words do not depend on their neighbours."""
    if _PLAIN.search(text) is None:
        chunks = text.lower().split()
        row += chunks
        plain.update(chunks)
        return
    for word in _library_words(model, text):
        row.append(_GAP + word)  # apart from plain chunks, which hold no such sign
        others.add(_GAP + word)


def encoded_column(text: Column, path: str, with_ids: bool = False) -> Column:
    """Number of ids and digests of the ids and of the text decoded from them; `with_ids` adds the ids."""
    schema = ENCODED + ", ids array<int>" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]

    @F.pandas_udf(schema)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = word_model(path)
        for batch in batches:
            for start in range(0, len(batch), _TEXTS):
                rows = []
                texts = [t if isinstance(t, str) else "" for t in batch.iloc[start:start + _TEXTS]]
                for ids in encode_texts(model, texts):
                    decoded = model.decode(ids).encode("utf-8")
                    row = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest())
                    rows.append((*row, ids.astype(np.int32)) if with_ids else row)
                yield pd.DataFrame(rows, columns=names)

    return of(text)


def ids_column(text: Column, path: str) -> Column:
    """The ids themselves, array<int>."""

    @F.pandas_udf("array<int>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = word_model(path)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch]
            yield pd.Series([ids.astype(np.int32) for ids in encode_texts(model, texts)], dtype=object)

    return of(text)


def decoded_column(ids: Column, path: str) -> Column:
    """The text of an array of ids; null for null."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = word_model(path)
        for batch in batches:
            yield pd.Series([None if i is None else model.decode(np.asarray(i)) for i in batch], dtype=object)

    return of(ids)
