"""Token ids of whole texts by the tokenizers library.

Both vocabularies split a text at white space before they merge, so a text's ids are
the ids of its words, in order. The words of a batch of texts are numbered, and a worker
asks the library once for a word that it meets for the first time; what it remembers is
bounded in bytes. Ids are then gathered by number. Where white space meets a space, a
byte-level vocabulary may join the two: such a text goes through the library as a whole.
"""

from __future__ import annotations

import os
import string
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderlake.llm.common import offsets_of

# ASCII marks, but for the apostrophe, which may go with the letters after it.
SIMPLE_MARKS = string.punctuation.replace("'", "")
# Unknown words that go through the library together.
TOGETHER = 500
# White space other than single spaces and line breaks, and all of it.
RARE_SPACE = "\t\v\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
ANY_SPACE = " \n" + RARE_SPACE
# Runs of marks that are remembered.
MOST_MARKS = 20_000
# What a remembered word takes beside its characters and ids.
WORD_COST = 200


def vocabulary(name: str) -> str:
    """Where a public vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes. ``spaced``: a word's ids depend on
    the space before it, as in byte-level vocabularies; otherwise white space is dropped.

    Remembered words take at most about twice ``most`` bytes, and a call's own words. A
    full dictionary becomes the old one; a word met again moves over from there, the
    others are forgotten at the next turn.
    """

    def __init__(self, path: str, spaced: bool, most: int = 96 << 20):
        # Spark runs a worker for each core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens in a text are ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.spaced, self.lead, self.most = spaced, " " if spaced else "", most
        # Ids that begin a word after a space (spaced), or end a word (not spaced).
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t[:1] == "Ġ" if spaced else t.endswith("</w>"))]] = True
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}
        self.held = 0

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that go through the library one by one."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def apart(self, text: str) -> bool:
        """Whether the library sees letters only, and so neither cuts nor joins the text
        with the marks after it."""
        return text.isalpha() and (
            self.spaced or text.isascii() or unicodedata.normalize("NFC", text).lower().isalpha()
        )

    def letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only that follow a space; the ids tell where each begins
        or ends."""
        out: list[bytes] = []
        for lo in range(0, len(words), TOGETHER):
            part = words[lo : lo + TOGETHER]
            ids = self.tokenizer.encode_batch_fast([self.lead + " ".join(part)], add_special_tokens=False)[0].ids
            edges = np.flatnonzero(self.edge[np.array(ids, np.int64)])
            if len(edges) != len(part):
                out += self.each([self.lead + w for w in part])
                continue
            raw = array("I", ids).tobytes()
            cuts = [*(4 * edges).tolist(), len(raw)] if self.spaced else [0, *(4 * edges + 4).tolist()]
            out += [raw[i:j] for i, j in zip(cuts, cuts[1:])]
        return out

    def line_starts(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only that follow a line break, which is a word of the
        library's own with an id of its own."""
        out: list[bytes] = []
        line = np.frombuffer(self.whole("\n"), "<u4")
        for lo in range(0, len(words), TOGETHER):
            part = words[lo : lo + TOGETHER]
            ids = self.tokenizer.encode_batch_fast(["\n" + "\n".join(part)], add_special_tokens=False)[0].ids
            at = np.flatnonzero(np.array(ids, np.int64) == line[0]) if len(line) == 1 else line[:0]
            if len(at) != len(part):
                out += self.each(part)
                continue
            raw = array("I", ids).tobytes()
            out += [raw[i + 4 : j] for i, j in zip((4 * at).tolist(), [*(4 * at[1:]).tolist(), len(raw)])]
        return out

    def learn(self, unknown: set[str]) -> None:
        """Ids of words that follow a space, or that begin with their line breaks. Words of
        letters go through the library together, the others one by one."""
        known, old = self.known, self.old
        for word in unknown.intersection(old):
            known[word] = old[word]
        plain, starts, others = [], [], []
        for word in unknown.difference(old):
            if self.apart(word):
                plain.append(word)
            elif word[:1] == "\n" and self.apart(word[1:]):
                starts.append(word)
            else:
                others.append(word)
        known.update(zip(plain, self.letters(plain)))
        line = self.whole("\n")
        known.update(zip(starts, (line + x for x in self.line_starts([w[1:] for w in starts]))))
        known.update(zip(others, self.each([w if w[:1] == "\n" else self.lead + w for w in others])))
        self.held += sum(map(len, unknown)) + sum(len(known[w]) for w in unknown) + WORD_COST * len(unknown)

    def core(self, word: str) -> str:
        """The word without its last marks, if the library always cuts before those."""
        core = word.rstrip(SIMPLE_MARKS)
        if len(core) == len(word):
            return word
        last = core[-1:]
        return core if last.isalnum() and (last.isascii() or self.apart(core)) else word

    def split(self, texts: list[str]) -> tuple[pa.LargeListArray, list[str]]:
        """(words, firsts): the words that follow a space, or that begin with their line
        breaks, and for each text what comes before those; there a text that must stay
        whole stays. The first word of each list belongs to ``firsts`` if ``spaced``."""
        held = pa.array(texts, pa.large_string())
        if not self.spaced:
            return pc.split_pattern(pc.replace_substring(held, "\n", " "), " "), []
        # A space beside other white space may join it.
        whole = pc.match_substring_regex(held, f"[{ANY_SPACE}] | [{ANY_SPACE}]| $")
        cut = pc.replace_substring(held, "\n", " \n")
        while pc.any(pc.match_substring(cut, "\n \n")).as_py():
            cut = pc.replace_substring(cut, "\n \n", "\n\n")
        cut = pc.if_else(pc.match_substring_regex(held, f"[{RARE_SPACE}]"), held, cut)
        words = pc.split_pattern(pc.if_else(whole, "", cut), " ")
        starts = pc.take(words.values, words.offsets[:-1]).to_pylist()
        return words, [t if w else x for t, w, x in zip(texts, whole.to_pylist(), starts)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; an empty text has none."""
        if not texts:
            return []
        if self.held > self.most:
            self.old, self.known, self.held = self.known, {}, 0
        words, firsts = self.split(texts)
        at = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        of = coded.indices.to_numpy().astype(np.int64)
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        cores = list(map(self.core, distinct))
        self.learn(set(cores).difference(self.known))
        marks = [w[len(c) :] for w, c in zip(distinct, cores)]
        for mark in set(marks).difference(self.marks):
            self.marks[mark] = self.whole(mark)
        found = [self.known[c] + self.marks[m] for c, m in zip(cores, marks)]
        if self.spaced:
            # No space comes before the first word.
            of[at[:-1]] = len(found) + np.arange(len(texts))
            found += self.each(firsts)
        if len(self.marks) > MOST_MARKS:
            self.marks = {"": b""}
        raw = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        lows = offsets_of(sizes)[:-1]
        ends = offsets_of(sizes[of])
        out = raw[np.repeat(lows[of] - ends[:-1], sizes[of]) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[at]).tolist()
        return [out[i:j] for i, j in zip(cuts, cuts[1:])]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """The worker's encoder of a vocabulary, kept between tasks."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced)
    return _encoders[path, spaced]
