"""Token ids of whole texts by the tokenizers library.

Texts in one corpus repeat their words, so a batch is split at its spaces and dictionary-coded
in Arrow, each distinct piece is looked up once, and ids are gathered by index. Only pieces not
seen before are encoded, many in one call with a special token between them. The ids equal
those of encoding the whole text:

* leading_space (byte-level BPE): its pre-tokenizer starts a token at a space that a
  visible character follows or precedes. A text with a space inside a longer run of white
  space is encoded whole.
* drop_space (BPE with word ends): white space never reaches the model.

Both pre-tokenizers part a run of ASCII punctuation (but for the apostrophe) that ends a piece
from the letters before it, so "word," is looked up as "word" and ",". Texts that spell a special token are encoded
whole as well; with plain_specials their special tokens are ordinary text.
"""

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hazline.llm.common import shared

# white space other than the plain space, as a class of the regular expressions of Arrow
_SPACES = r"\t-\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_RUN = rf"  |[{_SPACES}] (?:[{_SPACES} ]|\z)"
_LONG = 48
_TAIL = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")
# byte-level models spell bytes that are not printable Latin-1 characters as U+0100 onwards
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def byte_values(entry: str) -> bytes:
    """The bytes that an entry of a byte-level vocabulary stands for."""
    back = {chr(letter): byte for byte, letter in BYTE_LETTERS.items()}
    return bytes(back[c] if c in back else ord(c) for c in entry)


class _Pool:
    """Pieces with their ids end to end; a piece's code is its place."""

    def __init__(self):
        self.words = pa.array([], pa.string())
        self.ids, self.used = np.zeros(0, "<u4"), 0
        self.starts, self.lengths, self.last = (np.zeros(0, np.int64) for _ in range(3))

    def find(self, words: pa.Array, turn: int) -> np.ndarray:
        """Codes of pieces, -1 for those not here."""
        codes = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().astype(np.int64)
        self.last[codes[codes >= 0]] = turn
        return codes

    def add(self, words: list[str], flat: np.ndarray, lengths: np.ndarray, turn: int) -> None:
        lengths = np.asarray(lengths, np.int64)
        self.starts = np.append(self.starts, self.used + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.last = np.append(self.last, np.full(len(lengths), turn))
        if self.used + len(flat) > len(self.ids):
            self.ids = np.append(self.ids[: self.used], np.zeros(max(self.used, len(flat), 1 << 16), "<u4"))
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.words = pa.concat_arrays([self.words, pa.array(words, pa.string())])

    def keep(self, rows: np.ndarray) -> None:
        """Forgets all pieces but those at the given places."""
        flat, ends = self.gather(rows)
        lengths = np.diff(ends, prepend=0)
        self.ids, self.used = flat, len(flat)
        self.starts, self.lengths, self.last = ends - lengths, lengths, self.last[rows]
        self.words = self.words.take(pa.array(rows))

    def gather(self, codes: np.ndarray, more: list[list[int]] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ends of pieces; code -1 - n stands for the n-th of further lists of ids."""
        ids, starts, lengths = self.ids, self.starts, self.lengths
        if len(more):
            extra = np.array([len(each) for each in more], np.int64)[::-1]
            past = np.concatenate([np.array(each, "<u4") for each in reversed(more)])
            ids = np.concatenate([ids[: self.used], past.astype("<u4")])
            starts = np.concatenate([starts, self.used + np.cumsum(extra) - extra])
            lengths = np.concatenate([lengths, extra])
        size = lengths[codes]
        ends = np.cumsum(size)
        shift = np.repeat(starts[codes] - (ends - size), size)
        return ids[np.arange(len(shift)) + shift], ends


class Encoder:
    """Ids of texts, as one array of unsigned 32-bit integers with row bounds.

    The cache holds at most `entries` pieces before a batch; when it is full, the half used
    longest ago is forgotten.
    """

    def __init__(self, path: str, split: str, entries: int = 600_000, plain_specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if split not in ("leading_space", "drop_space"):
            raise ValueError(f"unknown split {split!r}")
        self.model = Tokenizer.from_file(path)
        self.whole = Tokenizer.from_file(path) if plain_specials else self.model
        self.whole.encode_special_tokens = plain_specials
        self.kept = split == "leading_space"
        self.entries = entries
        special = self.model.get_added_tokens_decoder()
        self.special = [token.content for token in special.values()]
        self.between, self.mark = max((v.content, k) for k, v in special.items())
        self.tails: dict[str, list[int]] = {}
        self.pool, self.turn = _Pool(), 0
        blank = self._whole([" "])[0] if self.kept else []
        self.pool.add([""], np.array(blank, "<u4"), [len(blank)], 0)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [row.ids for row in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        lead = " " if self.kept else ""
        joined = lead + (self.between + lead).join(words)
        ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        is_cut = ids == self.mark
        cuts = np.flatnonzero(is_cut)
        if len(cuts) != len(words) - 1:
            raise RuntimeError("the tokenizer does not keep its special token apart")
        lengths = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        self.pool.add(words, ids[~is_cut], lengths, self.turn)

    def _letters(self, words: list[str]) -> list[str]:
        """Learns words of Latin-1 letters straight from the model: each is one pre-token as it
        stands. Returns the others."""
        flat, lengths, learnt, others = [], [], [], []
        tokenize = self.model.model.tokenize
        lead = chr(BYTE_LETTERS[32]) if self.kept else ""
        for word in words:
            if not word.isalpha() or len(word) > _LONG or (not word.isascii() and max(word) > "\xff"):
                others.append(word)
                continue
            data = word if self.kept else word.lower()
            if not data.isascii():
                data = data.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = [token.id for token in tokenize(lead + data)]
            flat += ids
            lengths.append(len(ids))
            learnt.append(word)
        if learnt:
            self.pool.add(learnt, np.array(flat, "<u4"), lengths, self.turn)
        return others

    def _ended(self, words: list[str], parts: list[tuple[str, str]]) -> None:
        """Learns words of a known stem and a tail of punctuation."""
        stems = self.pool.find(pa.array([stem for stem, _ in parts], pa.string()), self.turn)
        if len(self.tails) > 10_000:
            self.tails.clear()
        new = list({tail for _, tail in parts}.difference(self.tails))
        self.tails.update(zip(new, self._whole(new), strict=True))
        tails = [self.tails[tail] for _, tail in parts]
        codes = np.column_stack([stems, -1 - np.arange(len(tails))]).ravel()
        flat, ends = self.pool.gather(codes, tails)
        self.pool.add(words, flat, np.diff(ends[1::2], prepend=0), self.turn)

    def _codes(self, words: pa.Array) -> np.ndarray:
        """Codes of distinct pieces; new ones are learnt."""
        found = self.pool.find(words, self.turn)
        missed = np.flatnonzero(found < 0)
        if not len(missed):
            return found
        new = words.take(pa.array(missed)).to_pylist()
        plain, ended, parts = set(), [], []
        for word in new:
            match = None if word.isalpha() else _TAIL.fullmatch(word)
            if match and match[1].isalpha():
                ended.append(word)
                parts.append(match.groups())
            else:
                plain.add(word)
        stems = list({stem for stem, _ in parts} - plain)
        known = self.pool.find(pa.array(stems, pa.string()), self.turn).tolist()
        plain.update(stem for stem, code in zip(stems, known, strict=True) if code < 0)
        others = self._letters(list(plain))
        for at in range(0, len(others), 2000):
            self._learn(others[at : at + 2000])
        if ended:
            self._ended(ended, parts)
        found[missed] = self.pool.find(words.take(pa.array(missed)), self.turn)
        return found

    def _trim(self) -> None:
        """Keeps the cache within its size: long pieces go, and the half used longest ago."""
        pool = self.pool
        if len(pool.words) <= self.entries and pool.used <= 16 * self.entries:
            return
        short = pool.lengths <= _LONG
        limit = np.partition(pool.last[short], -1 - self.entries // 2)[-1 - self.entries // 2] if (
            short.sum() > self.entries // 2
        ) else -1
        rows = np.flatnonzero(short & (pool.last > limit))
        pool.keep(np.unique(np.append(rows, 0)))

    def encode_column(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): row r has ids[bounds[r] : bounds[r + 1]], with the end id where one is given."""
        column = pc.fill_null(column, "")
        self.turn += 1
        self._trim()
        whole = pa.array(np.zeros(len(column), bool))
        for special in self.special:
            whole = pc.or_(whole, pc.match_substring(column, special))
        if self.kept:
            whole = pc.or_(whole, pc.match_substring_regex(column, _RUN))
        alone = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        split = pc.split_pattern(pc.if_else(whole, "", column) if len(alone) else column, " ")
        pieces = split.flatten()
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = pieces.dictionary_encode()
        codes = self._codes(coded.dictionary)[coded.indices.to_numpy()]
        more: list[list[int]] = []
        if self.kept:  # the first piece of a text has no space before it
            heads = pieces.take(pa.array(offsets[:-1])).dictionary_encode()
            more += self._whole(heads.dictionary.to_pylist())
            codes[offsets[:-1]] = -1 - heads.indices.to_numpy().astype(np.int64)
        if len(alone):
            codes[offsets[alone]] = -1 - len(more) - np.arange(len(alone))
            more += self._whole(column.take(pa.array(alone)).to_pylist())
        ids, ends = self.pool.gather(codes, more)
        bounds = np.concatenate([[0], ends])[offsets]
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers in bytes."""
        ids, bounds = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def shared_encoder(path: str, split: str, plain_specials: bool = False) -> Encoder:
    """One encoder per worker process, so that its cache serves all tasks that run there."""
    key = path, split, plain_specials
    return shared("encoders", key, lambda: Encoder(path, split, plain_specials=plain_specials))
