"""Tokenising whole texts word by word with the tokenizers library."""

from __future__ import annotations

import os
import re
from array import array
from functools import cache
from itertools import chain

import public_tokenizers

# A text may be cut without changing its tokens before a single space between two visible Latin
# characters: every pre-tokeniser rule of the two vocabularies ends a piece there (a space only
# starts a piece or is dropped), and no normalisation reaches across it. A text of which some space
# is not of that kind is cut only at those that are.
CUT = re.compile("(?<=[!-~¡-ɏ])(?= [!-~¡-ɏ])")
ODD_SPACE = re.compile(" (?:[^!-~¡-ɏ]|(?<=[^!-~¡-ɏ] )|$)")

# A word of runs of Latin letters, signs and single line ends is cut further, between the runs: each
# run is a piece of the pre-tokenisers. Digits and apostrophes, which follow other rules, and all
# other characters leave the word as it is. İ is left out, as it is two characters in lower case.
LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
SIGNS = r"!-&(-/:-@\[-`{-~"
RUNS = re.compile(f"(?: ?[{LATIN}]++| ?[{SIGNS}]++|\\n(?=[{LATIN}{SIGNS}]))++").fullmatch
RUN = re.compile(f" ?[{LATIN}]+| ?[{SIGNS}]+|\\n").findall

# Words and pieces of words kept with their ids in a Python worker; a full store starts anew.
WORDS_KEPT = 600_000
PIECES_KEPT = 100_000


@cache
def word_encoder(name: str) -> WordEncoder:
    """One encoder for each vocabulary file and Python worker; special tokens are ids of their own."""
    return WordEncoder(public_tokenizers.path(name), specials=True)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible bytes stand for themselves, the others take the letters from 256 on, in order.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class WordEncoder:
    """Ids of texts, looked up word by word.

    The library encodes a piece once while it is kept: a run of one kind of characters by its
    model, which takes a pre-token in byte letters, and any other word by the whole tokenizer.
    With ``specials``, a special token of the vocabulary that stands in a text is one id, as by
    the library's default; without, it is plain text (the library's ``encode_special_tokens``).
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT, pieces_kept: int = PIECES_KEPT, specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Texts are cut at special tokens first, so the library gets none of them.
        self._tokenizer.encode_special_tokens = True
        added = self._tokenizer.get_added_tokens_decoder() if specials else {}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip or not t.special for t in added.values()):
            raise ValueError(f"{path} has added tokens that are not found as they are written")
        self._specials = {t.content: array("I", [k]).tobytes() for k, t in added.items()}
        by_size = sorted(self._specials, key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(map(re.escape, by_size))})") if by_size else None
        self._model = self._tokenizer.model.tokenize
        # A vocabulary with a normaliser knows lower case only and drops white space.
        self._lower = self._tokenizer.normalizer is not None
        self._letters = byte_letters()
        self._words: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._words_kept, self._pieces_kept = words_kept, pieces_kept

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; none for a missing or an empty text."""
        cut = {} if self._special is None else {k: self._special.split(t) for k, t in enumerate(texts) if t and self._special.search(t)}
        if not cut:
            return self._encode_plain(texts)
        # Each text is the parts between special tokens, which stand at the odd places.
        parts = [cut.get(k, [t]) for k, t in enumerate(texts)]
        found = iter(self._encode_plain([p for ps in parts for p in ps[::2]]))
        return [b"".join(self._specials[p] if k % 2 else next(found) for k, p in enumerate(ps)) for ps in parts]

    def _encode_plain(self, texts: list[str | None]) -> list[bytes]:
        out, late = [], []
        for text in texts:
            if not text:
                out.append(b"")
                continue
            first, rest = _words(text)
            ids = list(map(self._words.get, rest))
            holes = _holes(ids)
            if holes:
                late.append((len(out), ids, holes, [rest[k] for k in holes]))
                out.append(self._ids(first))
            else:
                out.append(self._ids(first) + b"".join(ids))
        missing = set(chain.from_iterable(late_words for *_, late_words in late))
        if len(self._words) + len(missing) > self._words_kept:
            self._words.clear()
        for word in missing:
            self._words[word] = self._run(" ", word) if word.isascii() and word.isalpha() else self._ids(" " + word)
        for place, ids, holes, words in late:
            for k, word in zip(holes, words, strict=True):
                ids[k] = self._words[word]
            out[place] += b"".join(ids)
        return out

    def _ids(self, word: str) -> bytes:
        """Ids of a word with its leading space, piece by piece where it has pieces."""
        pieces = RUN(word) if RUNS(word) else None
        if pieces is None:
            return array("I", self._tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        found = []
        for piece in pieces:
            space, store = (" ", self._words) if piece[0] == " " else ("", self._pieces)
            run = piece.removeprefix(" ")
            ids = store.get(run)
            if ids is None:
                ids = store[run] = self._run(space, run)
            found.append(ids)
        if len(self._pieces) > self._pieces_kept:
            self._pieces.clear()
        return b"".join(found)

    def _run(self, space: str, run: str) -> bytes:
        if self._lower:
            space, run = "", run.strip().lower()
        if not run.isascii() or run == "\n":
            run = run.encode().decode("latin-1").translate(self._letters)
        return array("I", [t.id for t in self._model(self._letters[32] + run if space else run)]).tobytes()


def _holes(ids: list[bytes | None]) -> list[int]:
    """Places of None."""
    holes, k = [], -1
    try:
        while True:
            k = ids.index(None, k + 1)
            holes.append(k)
    except ValueError:
        return holes


def _words(text: str) -> tuple[str, list[str]]:
    """The first word of a text, and the others without the space before each."""
    if text[0] == " " or ODD_SPACE.search(text):
        first, *rest = CUT.split(text)
        return first, [w[1:] for w in rest]
    first, *rest = text.split(" ")
    return first, rest
