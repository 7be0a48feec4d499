"""Template residue and error-page text where a document should stand.

Two kinds of document are found:

* texts that consist of error messages, filler or demands for scripts, alone or under a heading.  A multi-pattern automaton marks fragments of such
  messages in several languages over the whole text.  Strong fragments decide, and so does a denial (built from forms and
  verbs) beside a thing that fails; weak ones count in a line that has a strong one, and a sentence
  counts whole where its marks cover about half of it.  Lines of nonsense words or pseudo-Latin count where they have hardly any of the words that hold ordinary ones
  together.  The document is excluded when the marks cover at least ``LEAST_COVERAGE`` of the letters of its body;
* texts in which a slot of a template was left unfilled, or was filled with what a program prints for no value.  The automaton finds openers and closers
  of slots and the empty values; what lies between is then verified.

The body is what follows the heading: the lines at the beginning that hold no marks and end like no sentence, and those that begin with a label and a colon and
are not residue themselves.  Navigation and reference codes are no letters of a body.  Slots in quotation marks, slots that a text names as markers, and redaction marks do not count.

Scale: a narrow map over the rows, without a shuffle; each text is read once by the automaton, in time that grows with its length whatever it holds.
Most texts have no strong fragment and are done then.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from brezza.llm import residue_words as W
from brezza.llm.batches import in_parts

LEAST_COVERAGE = 0.5
#: Of a sentence, to count it whole.
LEAST_OF_SENTENCE = 0.5
#: Words of a line without which nothing is said about their kind, the most function words that nonsense has, and the least share of nonsense words.
LEAST_WORDS, MOST_FUNCTION_WORDS = 4, 0.15
LEAST_NONSENSE = 0.6

_STRONG, _WEAK, _OPEN, _CLOSE, _EMPTY, _TELLING, _FAILURE, _THING = range(8)
_LONG_WORD = 64
_SYMMETRIC = ("@@", "%%", "$$", "__")
_PAIRS = {"{{": "}}", "${": "}", "#{": "}", "{%": "%}", "<%": "%>", "<<": ">>", "[[": "]]", "&lt;": "&gt;", "{": "}", "«": "»", "[": "]", "(": ")", "<": ">"}
_FREE = ("{{", "${", "#{", "{%", "<%")
_NAME = re.compile(r":?\s*[A-Za-z][\w.-]*\s*:?")
_SENTENCES = re.compile(r"(?<=[.!?…])\s+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_LETTER = re.compile(r"[^\W\d_]")
_FRAME = re.compile(r"File \"[^\"\n]*\"(?:, line \d+)?(?:, in \S+)?|\bat [\w.$<>]+\([^()\n]*\)|(?<![\w.$])[\w.$]*(?:Error|Exception|Failure|Warning)\b|\{main\}|\bin /\S+")
_NAVIGATION = re.compile(r"\s*[^\n·|›»•]+(?:[·|›»•][^\n·|›»•]*)+")
_SENTENCE_END = re.compile(r"[.!?…;][\"'»”’)\]]*$")
_LABELLED = re.compile(r"[^\W\d_][^\n:.!?]*:\s")
_PROSE_AFTER = re.compile(r"\s+(?:and|und|et|ed?|of|des?|der|die|in|to)\b")
_INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad\r"
_REPEATED = re.compile(r"(.{3,}?)\1+")
_LONGEST = max(map(len, W.LABELS | W.MARKER_WORDS)) + 3

_compiled: list[tuple[ahocorasick.Automaton, ahocorasick.Automaton]] = []


def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    """The automaton of all that may decide, and the one of strong and weak fragments; compiled once per process."""
    if not _compiled:
        strong = {p for group in (W.ERRORS, W.SCRIPTS, W.FILLERS) for phrases in group.values() for p in phrases}
        failures = {f"{denial} {done}" for denials, verbs in W.FAILURES.values() for denial in denials for done in verbs} - strong
        weak = {p for phrases in W.CARRIERS.values() for p in phrases} - strong - failures - W.FAILING_THINGS
        first, second = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase in strong:
            first.add_word(phrase, (_STRONG, len(phrase), phrase))
            second.add_word(phrase, (_STRONG, len(phrase), phrase))
        for phrase in failures:
            first.add_word(phrase, (_TELLING, len(phrase), phrase))
            second.add_word(phrase, (_FAILURE, len(phrase), phrase))
        for phrase in W.FAILING_THINGS - strong:
            second.add_word(phrase, (_THING, len(phrase), phrase))
        for phrase in weak:
            second.add_word(phrase, (_WEAK, len(phrase), phrase))
        for part in W.PROGRAM_ERRORS:
            if part not in strong:
                first.add_word(part, (_TELLING, len(part), part))
        for text in (*W.PROGRAM_VALUES, *W.EMPTY_WORDS):
            first.add_word(text.lower(), (_EMPTY, len(text), text.lower()))
        for opener, closer in _PAIRS.items():
            first.add_word(opener, (_OPEN, len(opener), opener))
            first.add_word(closer, (_CLOSE, len(closer), closer))
        for both in _SYMMETRIC:
            first.add_word(both, (_OPEN, 2, both))
        first.make_automaton()
        second.make_automaton()
        _compiled.append((first, second))
    return _compiled[0]


def _lower(text: str) -> str:
    """In lower case, character by character, so that places stay the same."""
    lower = text.lower()
    return lower if len(lower) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def _whole(text: str, begin: int, end: int) -> bool:
    """Whether a match is not a part of a longer word."""
    return (begin == 0 or not (text[begin - 1].isalnum() and text[begin].isalnum())) and (end == len(text) or not (text[end].isalnum() and text[end - 1].isalnum()))


def _word_before(text: str, at: int) -> str:
    """The word before a place on the same line; of one longer than any word that is asked for, its end."""
    while at and text[at - 1] == " ":
        at -= 1
    end = at
    while at and end - at <= _LONGEST and not text[at - 1].isspace():
        at -= 1
    return text[at:end]


def _quoted(text: str, begin: int, end: int) -> bool:
    while begin and text[begin - 1] == " ":
        begin -= 1
    while end < len(text) and text[end] == " ":
        end += 1
    return 0 < begin and end < len(text) and text[begin - 1] in W.OPEN_QUOTES and text[end] in W.CLOSE_QUOTES


def _spoken_of(text: str, begin: int, end: int) -> bool:
    """Whether a slot or value is quoted, or named as a marker."""
    return _quoted(text, begin, end) or _word_before(text, begin).strip("(:,").lower() in W.MARKER_WORDS


def _is_field(inside: str) -> bool:
    words = inside.replace("_", " ").replace("-", " ").lower().split()
    return bool(words) and all(w in W.FIELD_WORDS for w in words)


@lru_cache(maxsize=1)
def _instructions() -> re.Pattern:
    return re.compile(r"(?<!\w)(?:" + "|".join(sorted(map(re.escape, W.INSTRUCTIONS), key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)


def _is_slot(opener: str, inside: str) -> bool:
    """Whether what stands between an opener and its closer is a slot."""
    if not inside.strip() or "\n" in inside:
        return False
    if opener in _FREE:
        return not any(c in inside for c in "{}") and any(c.isalpha() for c in inside)
    if opener == "«":
        name = inside.strip()
        special = any(c in name for c in "_.-") or (not name.islower() and not name.istitle())
        return bool(_NAME.fullmatch(name)) and " " not in name and (special or _is_field(name))
    if opener in "[(<":
        if _instructions().search(inside):
            return True
        words = inside.replace("_", " ").split()
        return opener != "(" and inside.upper() == inside and all(w.isalpha() for w in words) and _is_field(inside) or opener == "[" and inside.lower().startswith("your ") and _is_field(inside)
    if opener == "{":
        return bool(_NAME.fullmatch(inside)) and " " not in inside
    return bool(_NAME.fullmatch(inside))


def _stands_for_something(text: str, begin: int, end: int, value: str) -> bool:
    """Whether an empty value stands alone or where a name, number or date belongs, not in the flow of a sentence."""
    if value in W.PROGRAM_VALUES:
        return True
    word = _word_before(text, begin)
    before = not word or word[-1] in ".!?)”»:(—]" or word.lower().rstrip(".") in W.LABELS
    return before and not _PROSE_AFTER.match(text, end)


def _is_part_of_longer(text: str, begin: int, opener: str) -> bool:
    """Whether an opener of one character is the end of a longer one."""
    return opener in "{[<" and begin > 0 and text[begin - 1] in opener + "$#"


def _read(text: str, lower: str) -> tuple[str | None, bool]:
    """The first unfilled slot or empty value, and whether the text has anything that could make it residue."""
    open_at: dict[str, int] = {}
    telling = False
    for last, (kind, length, pattern) in _automata()[0].iter(lower):
        begin, end = last + 1 - length, last + 1
        if kind == _STRONG:
            telling = telling or pattern in W.PROGRAM_ERRORS or _whole(lower, begin, end)
        elif kind == _TELLING:
            telling = True
        elif kind == _EMPTY:
            value = text[begin:end]
            if (value in W.PROGRAM_VALUES or value in W.EMPTY_WORDS) and _whole(text, begin, end) and not _spoken_of(text, begin, end) and _stands_for_something(text, begin, end, value):
                return value, telling
        elif kind == _OPEN and pattern in _SYMMETRIC:
            start = open_at.get(pattern)
            if start is not None and begin >= start + 2:
                del open_at[pattern]
                if _is_slot(pattern, text[start + 2 : begin]) and not _spoken_of(text, start, end):
                    return text[start:end], telling
            open_at[pattern] = begin
        elif kind == _OPEN:
            open_at[pattern] = begin
        else:
            for opener, closer in _PAIRS.items():
                start = open_at.get(opener) if closer == pattern else None
                if start is None or start + len(opener) > begin:
                    continue
                del open_at[opener]
                inside = text[start + len(opener) : begin]
                if _is_slot(opener, inside) and not _is_part_of_longer(text, start, opener) and not _spoken_of(text, start, end):
                    return text[start:end], telling
    return None, telling


def unfilled_slot(text: str) -> str | None:
    """The first slot that was left unfilled or filled with an empty value."""
    return _read(text, _lower(text))[0]


def _is_nonsense(word: str) -> bool:
    """Whether a word in lower case is filler, a run on a keyboard, or one letter over and over."""
    if word in W.NONSENSE or word in W.LATIN_WORDS:
        return True
    repeated = _REPEATED.fullmatch(word)
    run = repeated.group(1) if repeated else word
    return len(word) >= 3 and (len(set(word)) == 1 or (len(word) >= 4 and any(run in row or run in row[::-1] for row in W.KEYBOARD_ROWS)))


def _is_babble(words: list[str]) -> bool:
    """Whether words form no sentence: most are nonsense, or all look Latin, and hardly any holds a sentence together."""
    small = [w for w in words if w[0].islower()]
    if len(small) < LEAST_WORDS:
        return bool(words) and all(w.lower() in W.NONSENSE for w in words)
    held = sum(w in W.FUNCTION_WORDS and w not in W.LATIN_WORDS for w in small)
    if held > MOST_FUNCTION_WORDS * len(small):
        return False
    if sum(map(_is_nonsense, small)) >= LEAST_NONSENSE * len(small):
        return True
    # Latin by its syllables only: more words are asked for, as words of living languages have such syllables too.
    return len(small) >= 2 * LEAST_WORDS and all(map(_looks_latin, small))


@lru_cache(maxsize=1)
def _syllables() -> frozenset[str]:
    return frozenset("".join(parts) for parts in product(("", *W.LATIN_ONSETS), W.LATIN_VOWELS, ("", *W.LATIN_CODAS)))


def _is_syllables(word: str) -> bool:
    known, longest, reached = _syllables(), max(map(len, _syllables())), bytearray(len(word) + 1)
    reached[0] = 1
    for end in range(1, len(word) + 1):
        reached[end] = any(reached[begin] and word[begin:end] in known for begin in range(max(0, end - longest), end))
        if not any(reached[max(0, end - longest) : end + 1]):
            return False
    return bool(reached[-1])


_remembered_syllables = lru_cache(maxsize=100_000)(_is_syllables)


def _looks_latin(word: str) -> bool:
    """Whether a word is made of Latin syllables."""
    return word.isascii() and (_remembered_syllables(word) if len(word) <= _LONG_WORD else _is_syllables(word))


def _letters(text: str) -> int:
    return len(_LETTER.findall(text))


def _without_codes(text: str) -> str:
    """A text without paths and words that hold a digit."""
    return " ".join(w for w in text.split() if not any(map(str.isdigit, w)) and w.count("/") + w.count("\\") < 2)


def _judge(sentence: str) -> tuple[int, int, bool]:
    """(marked letters, letters, whether a strong fragment is among the marks) of a sentence; its function words are no letters where something is marked."""
    plain = _without_codes(sentence)
    spans = [m.span() for m in _FRAME.finditer(plain)]
    framed = bool(spans)
    lower, kinds = _lower(plain), set()
    for last, (kind, length, _) in _automata()[1].iter(lower):
        begin, end = last + 1 - length, last + 1
        if _whole(lower, begin, end):
            spans.append((begin, end))
            kinds.add(kind)
    strong = _STRONG in kinds or {_FAILURE, _THING} <= kinds or framed
    words = list(_WORD.finditer(plain))
    letters = _letters(plain)
    if not strong and len(words) <= 3 and len(plain.split()) < len(sentence.split()):
        # A label and its code say nothing.
        return 0, 0, False
    if not spans:
        return 0, letters, False
    marked = bytearray(len(plain))
    for begin, end in spans:
        marked[begin:end] = b"\x01" * (end - begin)
    covered = sum(_letters(plain[m.start() : m.end()]) for m in re.finditer(b"\x01+", marked))
    letters -= sum(len(w.group()) for w in words if w.group().lower() in W.FUNCTION_WORDS and not marked[w.start()])
    return letters if covered >= LEAST_OF_SENTENCE * letters else covered if strong else 0, letters, strong


def _judge_line(line: str, telling: bool) -> tuple[int, int, bool]:
    """(marked letters, letters, whether anything is marked) of a line; without ``telling`` fragments only babble may be marked."""
    words = _WORD.findall(line)
    if _is_babble(words):
        return (n := sum(map(len, words))), n, True
    if not telling:
        return 0, sum(map(len, words)), False
    judged = [_judge(s) for s in _SENTENCES.split(line)]
    # Sentences of weak fragments count beside one with a strong fragment.
    found = any(strong for _, _, strong in judged)
    return sum(m for m, _, _ in judged) if found else 0, sum(n for _, n, _ in judged), found


def _is_sentence(line: str) -> bool:
    """Whether a line ends like a sentence, not with an abbreviation, and has a word that holds one together."""
    return bool(_SENTENCE_END.search(line)) and "." not in line.split()[-1].rstrip(".") and any(w in W.FUNCTION_WORDS for w in _WORD.findall(line))


def residue_coverage(text: str, telling: bool = True) -> float:
    """Share of the letters of a text's body that marks cover; 0 where there is no body, or where it must stay below ``LEAST_COVERAGE``."""
    marked = total = 0
    heading, left = True, len(text)
    for line in text.split("\n"):
        left -= len(line)
        line = line.strip()
        if not line:
            continue
        if _NAVIGATION.fullmatch(line) and all(len(part.split()) <= 3 for part in re.split("[·|›»•]", line)):
            continue
        own, letters, found = _judge_line(line, telling)
        label = _LABELLED.match(line) if heading else None
        if heading and (own < LEAST_COVERAGE * letters and not (telling and _judge(label.group())[2]) if label else not found and not _is_sentence(line)):
            continue
        heading = False
        marked += own
        total += letters
        if marked + left < LEAST_COVERAGE * (total + left):
            return 0.0
    return marked / total if total else 0.0


def _plain(text: str) -> str:
    """A text without invisible characters, with plain spaces."""
    for other in ("\xa0", "\t"):
        if other in text:
            text = text.replace(other, " ")
    for invisible in _INVISIBLE:
        if invisible in text:
            text = text.replace(invisible, "")
    return text


def reason_of(text: str | None) -> str | None:
    """``slot`` or ``residue``; null for other texts, also null and empty ones and those without any letter."""
    if not text:
        return None
    plain = _plain(text)
    slot, telling = _read(plain, _lower(plain))
    if slot:
        return "slot"
    return "residue" if residue_coverage(plain, telling) >= LEAST_COVERAGE else None


def find_residue(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key, reason`` of each document to exclude; rows that repeat come out as often; an empty table gives none."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_parts(batches):
            reasons = [reason_of(t) for t in b.column(1).to_pylist()]
            at = pa.array([k for k, r in enumerate(reasons) if r], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([r for r in reasons if r], pa.string())], [key, "reason"])

    return documents.select(key, text).mapInArrow(find, T.StructType([documents.schema[key], T.StructField("reason", T.StringType())]))
