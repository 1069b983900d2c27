"""Licences named in texts: identifier tags and notice phrases."""

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tablebind.llm.common import alphanumeric_words, id_text, map_batches, texts

#: The phrases of the base count, and those the operator adds.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
MORE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc by sa": "cc-by-sa",
    "cc0 1 0 universal": "cc0",
}
#: Identifiers of the SPDX licence list that texts commonly name.
IDENTIFIERS = frozenset(
    "0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later "
    "apache-1.0 apache-1.1 apache-2.0 apsl-1.0 apsl-2.0 artistic-1.0 artistic-1.0-perl artistic-2.0 "
    "beerware blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause "
    "bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 cal-1.0 catosl-1.1 cc-by-1.0 cc-by-2.0 "
    "cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-1.0 cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0 "
    "cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 "
    "cc-by-sa-1.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cc-pddc cc0-1.0 cddl-1.0 cddl-1.1 "
    "cecill-1.0 cecill-2.0 cecill-2.1 cecill-b cecill-c cern-ohl-p-2.0 cern-ohl-s-2.0 cern-ohl-w-2.0 "
    "cpal-1.0 cpl-1.0 curl ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl "
    "gfdl-1.1 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-1.0-only gpl-1.0-or-later gpl-2.0 gpl-2.0-only "
    "gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg imagemagick ipl-1.0 isc json "
    "lgpl-2.0 lgpl-2.0-only lgpl-2.0-or-later lgpl-2.1 lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 "
    "lgpl-3.0-only lgpl-3.0-or-later libpng libpng-2.0 libtiff lppl-1.3c mit mit-0 mit-modern-variant mpl-1.0 "
    "mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 naist-2003 nasa-1.3 ncsa nist-pd ntp odbl-1.0 odc-by-1.0 "
    "ofl-1.0 ofl-1.1 oldap-2.8 openssl osl-1.0 osl-2.0 osl-2.1 osl-3.0 parity-7.0.0 pddl-1.0 php-3.0 php-3.01 "
    "polyform-noncommercial-1.0.0 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sgi-b-2.0 sissl sspl-1.0 "
    "tcl unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 xnet zend-2.0 zlib zpl-2.0 zpl-2.1".split()
)
#: Notices that name an identifier in words, such as "bsd 3 clause license".
MORE_PHRASES |= {f"{' '.join(re.split('[^a-z0-9]+', x))} license": x for x in sorted(IDENTIFIERS)}
TAG_PHRASE = "spdx license identifier"
TAG = re.compile(rb"spdx-license-identifier:[ \t]*([^\r\n]*)", re.I)
#: Licences a corpus may use when the caller names none.
ALLOWED = frozenset(
    "mit apache-2 apache-2.0 bsd bsd-2-clause bsd-3-clause isc cc0 cc0-1.0 zlib unlicense".split()
)
#: How much doubt one tag, and one notice, leaves.
TAG_DOUBT, NOTICE_DOUBT = 0.1, 0.3

_LEVEL = {"or": 1, "and": 2, "with": 3}
_NAME = re.compile(r"(documentref-[a-z0-9.-]*[a-z0-9]:)?[a-z0-9]([a-z0-9.+-]*[a-z0-9+])?")


def evaluate(expression: str, allowed: frozenset[str]) -> tuple[list[str], bool]:
    """Licence names of an and/or/with expression, and whether it can be met by ``allowed``.

    Operators go through a shunting-yard stack (with before and, and before or, parentheses).
    ``x with y`` is allowed if x is. An expression that is not well formed raises ValueError.
    """
    names: list[str | None] = []
    values: list[tuple[int | None, bool]] = []  # the place of a bare name, and whether it can be met
    stack: list[str] = []

    def apply() -> None:
        op = stack.pop()
        if op == "(" or len(values) < 2:
            raise ValueError(expression)
        (right, b), (left, a) = values.pop(), values.pop()
        if op == "with":
            if right is None or left is None:
                raise ValueError(expression)
            names[right] = None  # an exception is no licence
            values.append((None, a))
        else:
            values.append((None, a and b if op == "and" else a or b))

    operand = True
    for word in re.findall(r"[()]|[^\s()]+", expression.lower()):
        if word == "(" and operand:
            stack.append(word)
        elif word == ")" and not operand:
            while stack and stack[-1] != "(":
                apply()
            if not stack:
                raise ValueError(expression)
            stack.pop()
        elif word in _LEVEL and not operand:
            while stack and _LEVEL.get(stack[-1], 0) >= _LEVEL[word]:
                apply()
            stack.append(word)
            operand = True
        elif operand and _NAME.fullmatch(word) and word not in _LEVEL:
            values.append((len(names), word.removesuffix("+") in allowed))
            names.append(word)
            operand = False
        else:
            raise ValueError(expression)
    while stack:
        apply()
    if len(values) != 1:
        raise ValueError(expression)
    return [x for x in names if x is not None], values[0][1]


def tag_expression(line: str, allowed: frozenset[str]) -> tuple[list[str], bool]:
    """``evaluate`` of the longest well-formed expression that a tag's line begins with.

    What follows it (closing marks, markup, prose) does not count. A name after an operator is
    one if it is a known identifier or looks like one by a digit or a prefix, so that the words
    of a sentence are none.
    """
    words: list[str] = []
    ends: list[int] = []
    depth, operand, at = 0, True, 0
    line = line.lower().lstrip(" \t\"'`")
    while True:
        at += len(line[at:]) - len(line[at:].lstrip(" \t"))
        found = _NAME.match(line, at)
        word = found[0] if found else line[at : at + 1]
        if word == "(" and operand:
            depth += 1
        elif word == ")" and not operand and depth:
            depth -= 1
        elif word in _LEVEL and not operand:
            operand = True
        elif found and operand and word not in _LEVEL and (not words or _is_name(word)):
            operand = False
        else:
            break
        words.append(word)
        at += len(word)
        if not depth and not operand:
            ends.append(len(words))
    for end in reversed(ends):
        try:
            return evaluate(" ".join(words[:end]), allowed)
        except ValueError:
            continue
    raise ValueError(line)


def _is_name(word: str) -> bool:
    plain = word.removesuffix("+")
    prefixed = word.startswith(("licenseref-", "documentref-"))
    return plain in IDENTIFIERS or prefixed or "exception" in word or any(c.isdigit() for c in word)


def _automaton(phrases):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for phrase in phrases:
        machine.add_word(f" {phrase} ", phrase)
    machine.make_automaton()
    return machine


def licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE_PHRASES,
    more: dict[str, str] = MORE_PHRASES,
    allowed: frozenset[str] = ALLOWED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, bad_tags, usable.

    One Aho-Corasick pass over the words of a text finds every phrase and identifier tag. A tag's
    expression is the longest well-formed one at the start of its line; its licence names
    are labels. A tag without any counts in ``bad_tags`` and adds no label. ``usable``
    is null without any label, else whether all notices and tags can be met by ``allowed``.

    A null text is empty: no words, empty label texts, score 0, null first and last word.
    Repeated rows each give a row; other columns are not read.
    """
    known = {**more, **base}

    def scan(batches):
        machine = _automaton([*known, TAG_PHRASE])
        for batch in batches:
            out = []
            for data in texts(batch, "text"):
                words = alphanumeric_words(data)
                line = f" {b' '.join(words).decode()} "
                starts, labels, base_labels, tagged, notices = [], set(), set(), False, 0
                at = counted = 0
                for end, phrase in machine.iter(line):
                    if phrase == TAG_PHRASE:
                        tagged = True
                        continue
                    notices += 1
                    labels.add(known[phrase])
                    if phrase in base:
                        begin = end - len(phrase) - 1
                        if begin >= at:
                            counted += line.count(" ", at, begin + 1)
                            at = begin + 1
                            starts.append(counted - 1)
                        else:
                            starts.append(line.count(" ", 0, begin + 1) - 1)
                        base_labels.add(base[phrase])
                usable = labels <= allowed
                bad = good = 0
                for m in TAG.finditer(data) if tagged else ():
                    try:
                        names, met = tag_expression(m[1].decode(errors="replace"), allowed)
                    except ValueError:
                        bad += 1
                        continue
                    good += 1
                    labels.update(names)
                    usable = usable and met
                out.append(
                    (
                        len(words),
                        len(starts),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base_labels)),
                        ",".join(sorted(labels)),
                        1 - NOTICE_DOUBT**notices * TAG_DOUBT**good,
                        bad,
                        usable if labels else None,
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64(), pa.bool_()]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], _COLUMNS)

    return map_batches(
        id_text(docs, id_col, text_col),
        scan,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, bad_tags long, usable boolean",
    )


_COLUMNS = (
    "doc_id n_words n_base first_word last_word base_labels labels score bad_tags usable".split()
)
