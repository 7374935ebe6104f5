"""Encoding whole texts with the tokenizers library, word by word through a cache.

A byte-level BPE tokenizer first cuts a text into pieces that it encodes one by one.  A piece never goes on past a
blank that follows a word, so a text can be cut there, and each distinct word (with its leading blank) needs
encoding only once.  A full stop or comma behind a letter or digit is a piece of its own there, and so is a single line
end between two signs, so texts are cut at these too and far fewer words are distinct.  Words that end in white space,
where none of this need hold, send their text to the library whole, and so do texts with added tokens in them.

Texts are taken some megabytes at a time: Arrow cuts them and numbers their distinct words, only these are looked up
or encoded, and numpy lays their ids out in the order of the texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfcast.llm.workers import CACHES, pieces

#: Most words that are kept because they came again; most words, twice, that wait to come again.
CACHED_WORDS = 300_000
WAITING_WORDS = 150_000
#: Bytes of text that are best encoded together.
TOGETHER = 4 << 20
#: Bytes of text, in parts of that size, whose distinct words are looked up together.
LOOKED_UP_TOGETHER = 16 << 20


#: Begins a word that has no blank before it; texts that hold it go to the library whole.
MARK = "\x01"
#: Where texts are cut besides at blanks, in this order.
CUTS = (("\n", f" {MARK}\n {MARK}"), (". ", f" {MARK}. "), (", ", f" {MARK}, "))
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LETTER_OR_DIGIT = f"^[A-Za-z0-9{_LATIN}]$"
_SIGN = f"^[!-~{_LATIN}]$"
_LETTERS = re.compile(f"[A-Za-z{_LATIN}]+")
#: What is known of a distinct word, one bit each.
_BAD, _STOP, _LINE_END, _WELL, _ENDS_SIGN, _BEGINS_SIGN = (np.uint8(1 << k) for k in range(6))


def _by_character(characters: pa.Array, *tests: Callable[[pa.Array], pa.Array]) -> list[np.ndarray]:
    """What each test finds of many characters, of which few are distinct."""
    found = characters.dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False)
    return [test(found.dictionary).to_numpy(zero_copy_only=False)[codes] for test in tests]


class WordCache:
    """Ids of words: a word is kept for good when it is asked for a second time; first sights wait for that with their
    ids, in two generations of which the older is dropped."""

    def __init__(self, kept: int = CACHED_WORDS, waiting: int = WAITING_WORDS):
        self.most, self.most_waiting = kept, waiting
        self.kept: dict[str, bytes] = {}
        self.waiting: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def look_up(self, words: Sequence[str]) -> list[bytes | None]:
        found = list(map(self.kept.get, words))
        for generation in (self.waiting, self.older):
            rest = [k for k, ids in enumerate(found) if ids is None]
            for k, ids in zip(rest, map(generation.get, [words[k] for k in rest])):
                if ids is not None:
                    found[k] = ids
                    if len(self.kept) < self.most:
                        self.kept[words[k]] = ids
        return found

    def learn(self, words: Sequence[str], ids: Sequence[bytes]) -> None:
        if len(self.waiting) + len(words) > self.most_waiting:
            self.waiting, self.older = {}, self.waiting
        self.waiting.update(zip(words[: self.most_waiting], ids))

    def clear(self) -> None:
        self.kept.clear()
        self.waiting.clear()
        self.older.clear()


class WordEncoder:
    """Ids of texts as numpy arrays; the caches belong to the Python worker and are bounded."""

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        steps = settings.get("pre_tokenizer") or {}
        self.by_word = settings.get("normalizer") is None and steps.get("type") == "ByteLevel" and (
            steps.get("use_regex", True) and not steps.get("add_prefix_space", True)
        ) and settings["model"]["type"] == "BPE" and not settings["model"].get("dropout") and (
            settings.get("truncation") is None and settings.get("padding") is None
        )
        self.added = [t["content"] for t in settings.get("added_tokens", [])]
        size = self.library.get_vocab_size()
        self.width = "<u2" if size <= 1 << 16 else "<u4"
        self.bytes = np.dtype(self.width).itemsize
        #: Which ids begin with a blank: in a list of words joined by blanks, these begin a word.
        self.starts = np.array([(self.library.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        #: How the library's model spells letters whose bytes are not characters of their own.
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {c: spell(chr(c))[0][0] for c in range(0xC0, 0x250)}
        self.words = WordCache(cached)

    def _whole(self, texts: Sequence[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), 256):
            found = self.library.encode_batch_fast(list(texts[at : at + 256]), add_special_tokens=False)
            out += [np.array(e.ids, dtype=self.width).tobytes() for e in found]
        return out

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words, each behind a blank, in texts of some of them; larger texts take longer for each word."""
        out: list[bytes] = []
        for at in range(0, len(words), 128):
            part = words[at : at + 128]
            # what the library returns takes a hundred times the ids, so it is not made for all words at once
            found = self.library.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)
            ids = np.array(found[0].ids, dtype=self.width)
            first = np.flatnonzero(self.starts[ids])
            if len(first) != len(part):  # cannot be told apart: one by one
                out += self._whole([" " + w for w in part])
                continue
            data, cuts = ids.tobytes(), (np.append(first, len(ids)) * self.bytes).tolist()
            out += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def _encode_words(self, words: Sequence[str]) -> list[bytes]:
        """Ids of words, marked ones alone and the others behind a blank.

        A word of letters is one piece, which the library's model takes as it is; other words are encoded as texts.
        """
        model = self.library.model.tokenize
        ids: list[int] = []
        ends, plain, marked = [0], [], []
        for k, word in enumerate(words):
            blank, text = ("", word[1:]) if word[0] == MARK else ("Ġ", word)
            if text.isascii() and text.isalpha():
                ids += [token.id for token in model(blank + text)]
            elif _LETTERS.fullmatch(text):
                ids += [token.id for token in model(blank + text.translate(self.spelt))]
            else:
                (plain if blank else marked).append(k)
            ends.append(len(ids))
        data, cuts = np.array(ids, dtype=self.width).tobytes(), (np.array(ends) * self.bytes).tolist()
        out = [data[a:b] for a, b in zip(cuts, cuts[1:])]
        for k, one in zip(plain, self._joined([words[k] for k in plain])):
            out[k] = one
        for k, one in zip(marked, self._whole([words[k][1:] for k in marked])):
            out[k] = one
        return out

    def _known(self, words: list[str]) -> list[bytes]:
        found = self.words.look_up(words)
        new = [k for k, ids in enumerate(found) if ids is None]
        if new:
            fresh = [words[k] for k in new]
            ids = self._encode_words(fresh)
            self.words.learn(fresh, ids)
            for k, one in zip(new, ids):
                found[k] = one
        return found

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Of each text where its words begin; their numbers; the distinct words; which texts have to be encoded whole."""
        cut = texts
        for sign, apart in CUTS:
            cut = pc.replace_substring(cut, sign, apart)
        lists = pc.split_pattern(pc.binary_join_element_wise(MARK, cut, ""), " ")
        starts = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = starts - starts[0]
        numbered = lists.flatten().dictionary_encode()
        codes, distinct = numbered.indices.to_numpy(zero_copy_only=False), numbered.dictionary
        size = pc.binary_length(distinct).to_numpy(zero_copy_only=False)
        marked = pc.starts_with(distinct, MARK).to_numpy(zero_copy_only=False)

        def which(word: str) -> np.ndarray:
            return pc.equal(distinct, word).to_numpy(zero_copy_only=False)

        line_end, stop = which(f"{MARK}\n"), which(f"{MARK}.") | which(f"{MARK},")
        well, ends_sign, spaced = _by_character(
            pc.utf8_slice_codeunits(distinct, -1), lambda c: pc.match_substring_regex(c, _LETTER_OR_DIGIT),
            lambda c: pc.match_substring_regex(c, _SIGN), pc.utf8_is_space,
        )
        (begins_sign,) = _by_character(pc.utf8_slice_codeunits(distinct, 1, 2), lambda c: pc.match_substring_regex(c, _SIGN))
        bad = (size == 0) | (marked & (size == 1)) | (spaced & ~line_end)
        known = bad * _BAD | stop * _STOP | line_end * _LINE_END | well * _WELL | ends_sign * _ENDS_SIGN
        here = (known | (marked & begins_sign) * _BEGINS_SIGN)[codes]
        # a stop is a piece of its own behind a letter or digit, a line end between two signs
        wrong = here & _BAD != 0
        before, after = here[:-1], here[1:]
        wrong[1:] |= (after & _STOP != 0) & (before & _WELL == 0) | (after & _LINE_END != 0) & (before & _ENDS_SIGN == 0)
        wrong[:-1] |= (before & _LINE_END != 0) & (after & _BEGINS_SIGN == 0)
        wrong[starts[1:] - 1] |= here[starts[1:] - 1] & _LINE_END != 0
        wrong[starts[:-1]] |= here[starts[:-1]] & (_STOP | _LINE_END) != 0
        return starts, codes, distinct, np.logical_or.reduceat(wrong, starts[:-1])

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, pa.DictionaryArray]:
        """The texts without nulls, how many words each has (minus one: it is encoded whole), and these words."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        filled = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        if not self.by_word or not len(texts):
            return texts, np.where(filled, -1, 0), pa.array([], pa.string()).dictionary_encode()
        special = np.zeros(len(texts), bool)
        for token in [*self.added, MARK]:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        starts, codes, distinct, wrong = self._words(texts)
        cut = filled & ~special & ~wrong
        if not cut.all():
            codes = codes[np.repeat(cut, np.diff(starts))]
            used = np.zeros(len(distinct), bool)
            used[codes] = True
            wanted = np.flatnonzero(used)
            number = np.zeros(len(distinct), np.int32)
            number[wanted] = np.arange(len(wanted))
            codes, distinct = number[codes], distinct.take(pa.array(wanted))
        return texts, np.where(cut, np.diff(starts), np.where(filled, -1, 0)), pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), distinct)

    def encode_parts(self, parts: Sequence[pa.Array], ids: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What ``encode_flat`` gives, for each of some lists of texts; their distinct words are looked up once."""
        cut = [self._cut(texts) for texts in parts]
        shared = pa.chunked_array([words for _, _, words in cut]).unify_dictionaries().chunks
        units = self._known(shared[0].dictionary.to_numpy(zero_copy_only=False).tolist())
        words_flat = np.frombuffer(b"".join(units), self.width)
        words_lengths = np.fromiter(map(len, units), np.int64, len(units)) // self.bytes
        for (texts, words, _), numbered in zip(cut, shared):
            order, flat, lengths = numbered.indices.to_numpy(zero_copy_only=False), words_flat, words_lengths
            at = np.flatnonzero(words < 0)
            if len(at):  # a text for the library is one unit among the others
                whole = self._whole(texts.take(pa.array(at)).to_pylist())
                words[at] = 0
                order = np.insert(order, np.cumsum(words)[at], len(units) + np.arange(len(at)))
                words[at] = 1
                flat = np.concatenate([flat, np.frombuffer(b"".join(whole), self.width)])
                lengths = np.concatenate([lengths, np.array([len(w) // self.bytes for w in whole], np.int64)])
            each = lengths[order]
            ends = np.append(0, np.cumsum(each))
            counts = np.diff(ends[np.append(0, np.cumsum(words))])
            if not ids:
                yield np.empty(0, self.width), counts
                continue
            kind = np.int32 if max(len(flat), int(ends[-1])) < 1 << 31 else np.int64
            first = np.cumsum(lengths) - lengths
            place = np.repeat((first[order] - ends[:-1]).astype(kind), each)
            place += np.arange(len(place), dtype=kind)
            yield flat[place], counts

    def encode_flat(self, texts: pa.Array, ids: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, as the library gives them without special tokens, and their numbers.

        A null text has none.  Without ``ids`` only the numbers are found.
        """
        return next(self.encode_parts([texts], ids))

    def _with_batches(self, batches: list[pa.RecordBatch], text: str, ids: bool) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for batch, found in zip(batches, self.encode_parts([b.column(text) for b in batches], ids)):
            yield batch, *found

    def encode_batches(self, batches: Iterator[pa.RecordBatch], text: str = "text", ids: bool = True) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """The batches in parts, each with what ``encode_flat`` gives for its texts."""
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in pieces(batches, text, TOGETHER, keep=True):
            more = pc.sum(pc.binary_length(batch.column(text))).as_py() or 0
            if held and size + more > LOOKED_UP_TOGETHER:
                yield from self._with_batches(held, text, ids)
                held, size = [], 0
            held.append(batch)
            size += more
        if held:
            yield from self._with_batches(held, text, ids)

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        ids, counts = self.encode_flat(pa.array(texts, pa.string()))
        ends = np.cumsum(counts).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's own encoder for a vocabulary file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def forget_words() -> None:
    """Drop the worker's word caches, for work that encodes nothing."""
    for units in _ENCODERS.values():
        units.words.clear()


CACHES.append(forget_words)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
