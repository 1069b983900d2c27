"""A public word BPE, cached by the runs between white space.

Its pre-tokenizer never joins characters across white space and its normalizer works
within such runs, so a text's ids are the ids of its runs one after the other. Runs repeat,
so nearly every one is a dictionary look-up.
"""

import os
import struct

import regex

from tablebind.llm.common import worker_memory

#: The pre-token pattern of the tokenizer's file, and its special tokens.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
WORD_END = "</w>"

#: Marks of which any number behind a word is one more pre-token.
MARKS = b".,;:!?)"

#: Runs and rarer pre-tokens of one age kept by a Python worker, and the longest worth keeping.
KEPT_RUNS, KEPT_WORDS, KEPT_LENGTH = 400_000, 50_000, 64
#: Below this code point the pattern above and the library's own agree on what is a letter.
PLAIN = "ɏ"


def load(path: str):
    """The library's tokenizer for a file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def whole_tokens(path: str) -> frozenset[str]:
    """The pre-tokens proven to be a single token.

    Every vocabulary entry that ends a word is spelled out, must be one pre-token that
    normalization leaves as it is, and is encoded alone by the library.
    """
    tokenizer, letters, proven = load(path), byte_letters(), set()
    candidates = []
    for entry, number in tokenizer.get_vocab().items():
        if entry.endswith(WORD_END) and len(entry) > len(WORD_END):
            raw = bytes(letters.get(c, 0) for c in entry[: -len(WORD_END)])
            try:
                word = raw.decode()
            except UnicodeDecodeError:
                continue
            if max(word) <= PLAIN and PRE_TOKEN.findall(word) == [word]:
                candidates.append((word, number))
    encoded = tokenizer.encode_batch([w for w, _ in candidates], add_special_tokens=False)
    for (word, number), result in zip(candidates, encoded, strict=True):
        if result.ids == [number]:
            proven.add(word)
    return frozenset(proven)


class Kept(dict):
    """What ``of`` gives for each key, computed when first asked for.

    When ``most`` keys are held they become the old ones, which go when there are as many new ones;
    an old key that is asked for is new again, so frequent keys stay.
    """

    def __init__(self, of, most: int):
        super().__init__()
        self.of, self.most, self.old = of, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.of(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def _runs(path: str, of_word, of_text, join) -> Kept:
    """Run -> ``join`` of what its pre-tokens give. ``of_word`` gets a pre-token and the model that
    merges it; a run with special tokens or rare letters goes as a whole to ``of_text``."""
    tokenizer = load(path)
    letters = {b: c for c, b in byte_letters().items()}

    model, normalize = tokenizer.model, tokenizer.normalizer.normalize_str

    def word(text: str):
        # Only printable ASCII stands for itself; control characters have stand-ins as well.
        plain = text.isascii() and text.isprintable()
        spelled = text if plain else "".join([letters[b] for b in text.encode()])
        return of_word(text, spelled, model)

    words = Kept(word, KEPT_WORDS)

    def run(raw: bytes):
        # Most runs are letters, perhaps with marks behind them: a pre-token and another one.
        bare = raw.rstrip(MARKS)
        if bare.isalpha():
            text = bare.lower().decode()
            first = of_word(text, text, model)
            return join((first, words[raw[len(bare) :].decode()])) if len(bare) < len(raw) else first
        text = raw.decode()
        if max(text) > PLAIN or (b"<|" in raw and any(s in raw for s in SPECIAL)):
            return of_text(tokenizer.encode(text, add_special_tokens=False).ids)
        normal = text.lower() if text.isascii() else normalize(text)
        if normal.isalpha():
            return word(normal)
        return join([words[x] for x in PRE_TOKEN.findall(normal)])

    return Kept(run, KEPT_RUNS)


PACKERS = [struct.Struct(f"<{n}I").pack for n in range(16)]


def _packed(ids: list[int]) -> bytes:
    return PACKERS[len(ids)](*ids) if len(ids) < len(PACKERS) else struct.pack(f"<{len(ids)}I", *ids)


def ids_owner(path: str) -> str:
    return f"ids {path}"


def id_runs(path: str) -> Kept:
    """Run -> its ids as little-endian unsigned 32-bit numbers."""

    def make() -> Kept:
        return _runs(
            path,
            lambda _, spelled, model: _packed([t.id for t in model.tokenize(spelled)]),
            _packed,
            b"".join,
        )

    return worker_memory(ids_owner(path), make)


def counts_owner(path: str) -> str:
    return f"counts {path}"


def count_runs(path: str, proven: frozenset[str]) -> Kept:
    """Run -> its number of tokens: proven pre-tokens count one, the others are merged."""

    def make() -> Kept:
        return _runs(
            path,
            lambda text, spelled, model: 1 if text in proven else len(model.tokenize(spelled)),
            len,
            sum,
        )

    return worker_memory(counts_owner(path), make)
