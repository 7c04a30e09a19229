"""Byte-pair encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round forms the keys of all neighbouring pairs, finds their ranks
by binary search over the sorted keys of the merge table, and merges in each word its lowest-ranked pair, everywhere it occurs, left to
right. Words without a pair left in the table leave the array. Merging all occurrences at once equals merging them one
by one because every merge makes a symbol of its own, and no later merge that uses the symbol ranks lower;
both are checked when the table is loaded.

The vocabulary is a public tokenizer file, given by path: byte level, with a mark at word ends, white space dropped. Its own
normaliser and word pattern are applied by the tokenizers library, but for texts of plain Latin letters, where Python does the same.
Since white space is dropped and never inside a word, stretches between spaces are encoded once per batch and kept
in a table of bounded size.

Defined results: null and empty texts have no ids and decode to the empty text; texts are encoded whole, however
long; repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.llm.common import ship_package, slices, text_or_empty

NO_RANK = np.iinfo(np.int32).max

#: Stretches a task remembers before it starts afresh.
REMEMBERED = 150_000

#: Text that is encoded at once.
ENCODE_BYTES = 2 << 20


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: its own if visible in Latin-1, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in visible)
    stand = {b: chr(256 + i) for i, b in enumerate(hidden)} | {b: chr(b) for b in visible}
    return [stand[b] for b in range(256)]


class BytePairs:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not self.suffix or model.get("dropout") or spec.get("post_processor") or spec.get("decoder"):
            raise ValueError(f"{path}: a byte-pair file with a mark at word ends and no decoder is needed")
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = np.full(size, "", dtype=object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token

        symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + self.suffix] for s in symbols], dtype=np.int64)
        self.width = size
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left, right, made = (np.array([vocab[t] for t in side], dtype=np.int64)
                             for side in ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs]))
        rank = np.arange(len(pairs), dtype=np.int64)
        made_at = np.full(size, -1, dtype=np.int64)
        made_at[made] = rank
        if len(np.unique(made)) != len(made) or (made_at[left] >= rank).any() or (made_at[right] >= rank).any():
            raise ValueError(f"{path}: merges must make each symbol once, before it is used")
        keys = left * size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], rank[order].astype(np.int32), made[order]
        self._plain_letters(spec)
        self.forget()

    def _plain_letters(self, spec: dict) -> None:
        """The Latin characters that Python lower-cases and splits as the library does, each one compared; texts of these
        alone need no call of the library."""
        import regex

        self.arrow_pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(self.arrow_pattern)
        codes = [*map(ord, "\t\n\v\f\r"), *range(0x20, 0x7F), *range(0xA1, 0x250)]
        same = []
        for c in map(chr, codes):
            probe, normal = f"a{c}1.{c}", self.library.normalizer.normalize_str(f"a{c}1.{c}")
            words = [bytes(self.byte_of[x] for x in w).decode() for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
            lowered = re.sub(r"\s", " ", probe.lower())
            cut = pc.ascii_split_whitespace(pc.replace_substring_regex(pa.array([normal]), pattern=self.arrow_pattern, replacement=r"\0 "))
            if [w for w in cut[0].as_py() if w] != words:
                continue
            if normal == lowered == re.sub(r"\s", " ", pc.utf8_lower(pa.array([probe]))[0].as_py()) and self.pattern.findall(normal) == words:
                same.append(c)
        self.plain = re.compile("[" + "".join(map(re.escape, same)) + "]*")
        self.not_plain = "[^" + "".join(rf"\x{{{ord(c):x}}}" for c in same) + "]"

    def forget(self) -> None:
        """Drop what was remembered: a worker that goes on to other work then holds the tables only."""
        self._words: dict[str, int] = {}
        self._word_ids, self._word_ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        self._seen: dict[str, int] = {}
        self._flat, self._ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        pa.default_memory_pool().release_unused()

    # -- words ----------------------------------------------------------------

    def _look_up(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pairs that begin at positions ``at``; NO_RANK across words and for unknown pairs."""
        rank, made = np.full(len(at), NO_RANK, np.int32), np.zeros(len(at), np.int64)
        inside = np.flatnonzero(at + 1 < len(symbol))
        inside = inside[word[at[inside]] == word[at[inside] + 1]]
        key = symbol[at[inside]] * self.width + symbol[at[inside] + 1]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[found] == key
        rank[inside[known]], made[inside[known]] = self.ranks[found[known]], self.made[found[known]]
        return rank, made

    def merge(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and the number of ids of each word; words are not empty."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[flat]
        stops = np.cumsum(lengths)
        symbol[stops - 1] = self.last[flat[stops - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        rank, made = self._look_up(symbol, word, np.arange(len(symbol)))
        done_symbols, done_words = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(symbol)]))
            ended = best == NO_RANK
            done_symbols.append(symbol[ended])
            done_words.append(word[ended])
            at = np.flatnonzero((rank == best) & ~ended)
            # In a run of overlapping hits (a pair of equal symbols) every second one is merged, from the left.
            begins = np.r_[True, np.diff(at) != 1][:len(at)]
            run_start = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbol[at] = made[at]
            keep = ~ended
            keep[at + 1] = False
            # Only pairs that hold a new symbol are looked up again.
            moved = (np.cumsum(keep) - 1)[at]
            symbol, word, rank, made = symbol[keep], word[keep], rank[keep], made[keep]
            touched = np.zeros(len(symbol) + 1, bool)
            touched[moved] = touched[moved - 1] = True
            changed = np.flatnonzero(touched[:-1])
            rank[changed], made[changed] = self._look_up(symbol, word, changed)
        symbols, owners = np.concatenate(done_symbols), np.concatenate(done_words)
        return symbols[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))

    def _split(self, stretch: str) -> list[str]:
        """Words of a normalised stretch, as text: by the file's own pattern where the letters are plain, else by the library."""
        if stretch.isascii() and stretch.isalpha():
            return [stretch]
        if self.plain.fullmatch(stretch):
            return self.pattern.findall(stretch)
        cut = self.library.pre_tokenizer.pre_tokenize_str(stretch)
        return [bytes(self.byte_of[c] for c in word).decode("utf-8", "surrogateescape") for word, _ in cut]

    def _learn(self, stretches: list[str], plain: bool = False) -> None:
        """Encode stretches between spaces that are new, and remember them."""
        if plain:
            # A space after each word: Arrow then cuts all stretches at once.
            cut = pc.ascii_split_whitespace(pc.replace_substring_regex(
                pa.array(stretches, pa.large_string()), pattern=self.arrow_pattern, replacement=r"\0 "))
            words, sizes = cut.values.dictionary_encode(), np.diff(cut.offsets.to_numpy())
            listed = words.dictionary.to_numpy(zero_copy_only=False).tolist()
            position = words.indices.to_numpy(zero_copy_only=False)
        else:
            split = [self._split(stretch) for stretch in stretches]
            listed = [word for words in split for word in words]
            position, sizes = np.arange(len(listed)), np.array(list(map(len, split)), np.int64)
        known = self._words
        new = [word for word in dict.fromkeys(listed) if word not in known]
        if new:
            filled = [word.encode("utf-8", "surrogateescape") for word in new if word]
            ids, counts = self.merge(filled)
            if "" in new:  # left at the end of a cut stretch: no ids
                counts = np.insert(counts, new.index(""), 0)
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            self._word_ids = np.concatenate([self._word_ids, ids.astype(np.int32)])
            self._word_ends = np.concatenate([self._word_ends, self._word_ends[-1] + np.cumsum(counts)])
        at = np.fromiter(map(known.__getitem__, listed), np.int64, len(listed))[position]
        ids, counts = gather(self._word_ids, self._word_ends, at)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        per = np.bincount(owner, weights=counts, minlength=len(sizes)).astype(np.int64)
        self._seen.update(zip(stretches, range(len(self._seen), len(self._seen) + len(stretches)), strict=True))
        self._flat = np.concatenate([self._flat, ids])
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(per)])

    # -- texts ----------------------------------------------------------------

    def _stretches(self, text: str) -> list[str]:
        if self.plain.fullmatch(text):
            return text.lower().split()
        return [x for x in self.library.normalizer.normalize_str(text).split(" ") if x]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where the ids of each text end, from 0 on."""
        if len(self._seen) > REMEMBERED:
            self.forget()
        texts = texts.cast(pa.large_string())
        odd = pc.match_substring_regex(texts, self.not_plain)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        words = pc.ascii_split_whitespace(pc.utf8_lower(texts.filter(pa.array(~odd))))
        distinct = words.values.dictionary_encode()
        listed = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = np.array([self._seen.get(word, -1) for word in listed], np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self._seen) + np.arange(len(new))
            self._learn([listed[i] for i in new], plain=True)
        flat, counts = gather(self._flat, self._ends, place[distinct.indices.to_numpy(zero_copy_only=False)])
        ends = np.r_[0, np.cumsum(counts)][words.offsets.to_numpy()]
        if not odd.any():
            return flat, ends
        others = self.encode(texts.filter(pa.array(odd)).to_pylist())
        flat = np.concatenate([flat, *others])
        ends = np.r_[ends, ends[-1] + np.cumsum(list(map(len, others)))]
        place = np.empty(len(texts), np.int64)
        place[~odd], place[odd] = np.arange((~odd).sum()), np.arange(odd.sum()) + (~odd).sum()
        flat, counts = gather(flat, ends, place)
        return flat, np.r_[0, np.cumsum(counts)]

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        if len(self._seen) > REMEMBERED:
            self.forget()
        parted: list[list[str | int]] = []
        for text in texts:
            pieces = self.special_pattern.split(text) if self.special_pattern else [text]
            parts: list[str | int] = []
            for i, piece in enumerate(pieces):
                parts += [self.special[piece]] if i % 2 else self._stretches(piece)
            parted.append(parts)
        new = set().union(*parted).difference(self._seen, self.special.values())
        if new:
            self._learn(list(new))
        out = []
        for parts in parted:
            special = [i for i, p in enumerate(parts) if type(p) is int] if self._ids_inside(parts) else []
            cuts = [-1, *special, len(parts)]
            ids = []
            for left, right in zip(cuts, cuts[1:], strict=False):
                if left >= 0:
                    ids.append(np.array([parts[left]], np.int64))
                stretch = parts[left + 1:right]
                at = np.fromiter(map(self._seen.__getitem__, stretch), np.int64, len(stretch))
                ids.append(gather(self._flat, self._ends, at)[0])
            out.append(ids[0] if len(ids) == 1 else np.concatenate(ids))
        return out

    def _ids_inside(self, parts: list[str | int]) -> bool:
        return any(i in parts for i in self.special.values())

    def decode(self, ids: np.ndarray) -> str:
        """As a file without a decoder is decoded: the tokens, special ones too, joined by single spaces."""
        return " ".join(self.tokens[ids].tolist())


def gather(flat: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``at`` of ``flat`` one after the other, and their lengths; stretch i is ends[i] to ends[i + 1]."""
    starts, counts = ends[at], ends[at + 1] - ends[at]
    shift = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return flat[np.arange(len(shift)) + shift], counts


@lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """The table, loaded once in each Python worker."""
    return BytePairs(path)


def encode_texts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded string``: one row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path)
        for batch in slices(batches, 1, ENCODE_BYTES):
            flat, ends = pairs.encode_array(batch.column(1))
            decoded = [pairs.decode(flat[start:stop]) for start, stop in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends.astype(np.int32), flat.astype(np.int32)), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"])
        pairs.forget()

    ship_package(docs.sparkSession)
    docs = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return docs.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")
