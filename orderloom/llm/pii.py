"""Personal data, plain or disguised, with spans in the source text.

Plain identifiers are found by their patterns. Disguises are undone by a transducer: it reads the source and
writes a normalised text (look-alike and styled letters and digits become ASCII, invisible characters vanish, digits
spelled as words become digits, "at" and "dot" in their usual disguises, boxed or parted signs become "@" and "."),
together with where each piece came from. The same detectors read the normalised text; what they find there is mapped back to
source characters and reported if a disguise was undone in it and no plain span of its kind overlaps it.

Every detector takes time in proportion to the text, also on long runs of one character class.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from orderloom.llm.spans import Span

KINDS = ("email", "ip", "card", "phone")
# Patterns of the plain identifiers. An address is found from its "@", a number chain whole.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Words for digits in English, German, French and Spanish, without the French article "un".
_WORDS = {
    word: str(digit)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro une deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for digit, word in enumerate(words.split())
}
# Words for the signs, and how often a word repeats the digit behind it.
_AT_WORDS, _DOT_WORDS = ("at", "arroba", "arobase"), ("dot", "punkt", "punto", "point")
_TIMES = {"double": 2, "triple": 3}
# ASCII letters that stand for digits beside digits.
_AS_DIGITS = str.maketrans("lIOo", "1100")
# Letters of other scripts that look like ASCII letters.
_LOOKALIKES = dict(
    zip(
        "АВЕКМНОРСТХУаеорсухіјѕԁԛԝһӏɡΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναı",
        "ABEKMHOPCTXYaeopcyxijsdqwhlgABEZHIKMNOPTYXovai",
    )
)
_INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"


def _glyphs() -> dict[str, str]:
    """Characters that stand for one ASCII character, and invisible ones, which stand for nothing.

    Styled and circled letters and digits are taken from their compatibility forms; raised and lowered ones are left.
    """
    table = dict(_LOOKALIKES) | {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)} | {c: "" for c in _INVISIBLE}
    for point in range(0x80, 0x20000):
        digit = unicodedata.decimal(chr(point), None)
        if digit is not None:
            table[chr(point)] = str(digit)
        elif unicodedata.decomposition(chr(point)).startswith(("<font>", "<circle>")):
            plain = unicodedata.normalize("NFKC", chr(point))
            if len(plain) == 1 and plain.isascii() and plain.isalnum():
                table[chr(point)] = plain
    return table


_GLYPHS = _glyphs()
_ANY_WORD = "|".join(_WORDS)
_TOKEN = re.compile(
    r"\x20?[\[({<]\x20?(?P<boxed>at|dot|@|\.)\x20?[\])}>]\x20?"
    r"|\x20?-(?P<dashed>at|dot)-\x20?|_(?P<under>at|dot)_"
    r"|(?<=[A-Za-z0-9])\x20(?P<parted>@(?=\x20[A-Za-z0-9])|\.(?=\x20[A-Za-z]))\x20"
    rf"|(?<![^\W_])(?a:(?P<times>{'|'.join(_TIMES)})[\x20-](?P<digit>{_ANY_WORD}))(?![^\W_])"
    rf"|(?<![^\W_])(?P<word>(?a:{'|'.join((*_AT_WORDS, *_DOT_WORDS))}|plus|{_ANY_WORD}))(?![^\W_])"
    r"|(?<![^\W_])(?P<like>(?-i:[lIOo]++[0-9][0-9lIOo]*+|[0-9]++[lIOo][0-9lIOo]*+))(?![^\W_])"
    r"|(?<=[0-9][.-])(?P<alone>(?-i:[lIOo]))(?=[.-][0-9])"
    # Classes with single characters beyond the basic plane are slow, so that plane is looked up.
    r"|[" + "".join(re.escape(c) for c in _GLYPHS if c < "\U00010000") + "\U00010000-\U0001ffff]",
    re.IGNORECASE,
)


def _emails(text: str) -> list[tuple[int, int]]:
    found, upto = [], 0
    for match in _AT.finditer(text) if "@" in text else ():
        start = match.start()
        while start > upto and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            found.append((start, match.end()))
            upto = match.end()
    return found


def _ips(text: str) -> list[tuple[int, int]]:
    found = []
    for chain in _CHAIN.finditer(text):
        if chain.end() - chain.start() < 7 or "." not in chain.group():
            continue
        parts = list(_DIGITS.finditer(text, *chain.span()))
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            if all(len(p := x.group().lstrip("0")) <= 3 and int(p or 0) <= 255 for x in four):
                found.append((four[0].start(), four[3].end()))
    return found


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _cards(text: str) -> list[tuple[int, int]]:
    found = []
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = match.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append(match.span())
    return found


def _phones(text: str) -> list[tuple[int, int]]:
    found = []
    for match in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
            found.append(match.span())
    return found


_DETECTORS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def normalise(text: str) -> tuple[str, list[int], list[tuple[int, int]], list[tuple[int, int]]]:
    """The text with its disguises undone; where the pieces start in it; their source ranges; undone ranges.

    Pieces alternate between copied and rewritten source; copied ones keep their length. The undone ranges are
    positions in the normalised text, invisible characters included as empty ranges.
    """
    tokens = list(_TOKEN.finditer(text))
    out: list[str] = []
    starts: list[int] = []
    ranges: list[tuple[int, int]] = []
    undone: list[tuple[int, int]] = []
    size = upto = 0

    def put(piece: str, start: int, end: int) -> None:
        nonlocal size
        starts.append(size)
        ranges.append((start, end))
        out.append(piece)
        size += len(piece)

    def blank(a: int, b: int) -> bool:
        return b - a <= 2 and not text[a:b].strip(" -,")

    def digits_follow(i: int, end: int) -> bool:
        """Whether the next token is a digit word, close enough to belong to the same number."""
        if i + 1 == len(tokens) or not blank(end, tokens[i + 1].start()):
            return False
        return bool(tokens[i + 1]["times"]) or (tokens[i + 1]["word"] or "").lower() in _WORDS

    for i, token in enumerate(tokens):
        start, end = token.span()
        word = (token["word"] or "").lower()
        sign = token["boxed"] or token["dashed"] or token["under"] or token["parted"]
        if sign:
            piece = "@" if sign.lower() in ("at", "@") else "."
        elif word in _AT_WORDS or word in _DOT_WORDS:
            if start < 2 or text[start - 1 : start] != " " or text[end : end + 1] != " ":
                continue
            start, end, piece = start - 1, end + 1, "@" if word in _AT_WORDS else "."
        elif word == "plus":
            if not digits_follow(i, end) and not text[end : end + 2].strip(" ").isdigit():
                continue
            piece = "+"
            end += text[end : end + 1] == " "
        elif word or token["times"]:
            piece = _WORDS[word] if word else _WORDS[token["digit"].lower()] * _TIMES[token["times"].lower()]
            if digits_follow(i, end):
                end = tokens[i + 1].start()
        elif token["like"] or token["alone"]:
            piece = token.group().translate(_AS_DIGITS)
        elif token.group() in _GLYPHS:
            piece = _GLYPHS[token.group()]
        else:
            continue
        if start < upto:
            start = upto
        if start > upto:
            put(text[upto:start], upto, start)
        undone.append((size, size + len(piece)))
        put(piece, start, end)
        upto = max(upto, end)
    if upto < len(text):
        put(text[upto:], upto, len(text))
    return "".join(out), starts, ranges, undone


_GLYPH = frozenset(_GLYPHS)
_BOXED = re.compile(r"[\[({<]\x20?(?:at|dot|@|\.)\x20?[\])}>]", re.IGNORECASE)
_DIGIT_WORD = rf"(?<![^\W_])(?:{_ANY_WORD})(?![^\W_])"
_SPELLED = re.compile(_DIGIT_WORD)
_NEXT = re.compile(rf"(?:[\x20,-]{{1,2}}|\.)(?:[0-9]|{_DIGIT_WORD})")
_REPEATED = re.compile(rf"(?:{'|'.join(_TIMES)})[\x20-]{_DIGIT_WORD}")
_LIKE = re.compile(r"[0-9][lIOo]|[lIOo][0-9]|[0-9][.-][lIOo][.-][0-9]")
_DOT_THEN_NUMBER = re.compile(rf"\x20(?:{'|'.join(_DOT_WORDS[1:])})\x20(?:[0-9]|{_DIGIT_WORD})")
_AT_WORD = re.compile(rf"(?<![^\W_])(?:{'|'.join(_AT_WORDS)})(?![^\W_])|\x20@\x20", re.IGNORECASE)
_DOT_WORD = re.compile(rf"\x20(?:{'|'.join(_DOT_WORDS)})\x20|-dot-|_dot_|[\[({{<]\x20?dot\x20?[\])}}>]|[\[({{<]\x20?\.\x20?[\])}}>]|\x20\.\x20", re.IGNORECASE)
_LED = re.compile(rf"\+[\x20().0-9-]*+{_DIGIT_WORD}")
_PLUS = re.compile(rf"plus[\x20,-]{{1,2}}(?:[0-9]|{_DIGIT_WORD})")
# Endings of addresses that are believed where "at" and "dot" are plain words.
_ENDINGS = frozenset("com org net edu gov mil int info biz name io co ai dev app me tv eu us uk de fr es it nl ch at be pl se no dk fi pt ie ca au nz jp cn in br mx ru".split())
# Those of them that are no words, for addresses whose dot is parted by blanks like the end of a sentence.
_NO_WORDS = frozenset("com org net edu gov mil biz io eu uk".split())


def _worth(text: str) -> bool:
    """Whether the text may hold a disguise: whatever `_disguised` can find meets one of these conditions.

    A span holds a rewritten piece. Look-alikes, boxes and "dot" as a word are looked for as such, and "at" as a word
    counts only with a "dot". A "plus" must precede a number. A digit word lies in a chain of digits, or behind a "+".
    A parted dot counts only with an "@", a letter for a digit only beside digits, and a "dot" of another language only
    with an "at" or before a number.
    """
    low = text.lower()
    at = " at " in low or " arroba " in low or " arobase " in low
    if " dot " in low or (at and "dot" in low):
        return True
    if any(sign in low for sign in ("-at-", "-dot-", "_at_", "_dot_")) or ("@" in low and " . " in low):
        return True
    if any(word in low for word in _DOT_WORDS[1:]) and (at or "@" in low or _DOT_THEN_NUMBER.search(low)):
        return True
    if _LIKE.search(text) or (("double" in low or "triple" in low) and _REPEATED.search(low)):
        return True
    if not text.isascii() and not _GLYPH.isdisjoint(text):
        return True
    if any(c in low for c in "[({<") and _BOXED.search(low):
        return True
    if ("+" in low and _LED.search(low)) or ("plus" in low and _PLUS.search(low)):
        return True
    for match in _SPELLED.finditer(low):
        start = match.start()
        if _NEXT.match(low, match.end()) or (start > 1 and low[start - 1] in " -.," and low[start - 2] in "0123456789"):
            return True
    return False


def _believed(source: str, ending: str) -> bool:
    """Whether a disguised address is taken for one.

    "at" as a plain word, or a parted "@", is taken for the sign only with a disguised dot and a known ending. A parted
    dot may end a sentence: it counts only with an "@" and an ending that is no word.
    """
    if len(ending) < 2 or not ending.isalpha():
        return False
    bare = _BOXED.sub(lambda box: "" if "." not in box.group() else box.group(), source)
    parted = re.search(r"\x20\.\x20", _BOXED.sub("", source)) is not None
    if parted and (ending.lower() not in _NO_WORDS or _AT_WORD.search(bare.replace(" @ ", "@"))):
        return False
    return not _AT_WORD.search(bare) or (_DOT_WORD.search(source) is not None and ending.lower() in _ENDINGS)


def _disguised(text: str) -> list[tuple[str, int, int]]:
    clean, starts, ranges, undone = normalise(text)
    firsts = [u[0] for u in undone]
    found = []
    for kind, detect in _DETECTORS.items():
        for start, end in detect(clean):
            inside = [clean[a:b] for a, b in undone[bisect_right(firsts, start - 1) : bisect_right(firsts, end - 1)] if b <= end]
            if not inside:
                continue
            first, last = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
            a, b = ranges[first], ranges[last]
            # A copied piece keeps its length, so positions in it shift; a rewritten one is taken whole.
            copied = lambda i, r: (starts[i + 1] if i + 1 < len(starts) else len(clean)) - starts[i] == r[1] - r[0]
            source_start = a[0] + (start - starts[first] if copied(first, a) else 0)
            source_end = b[0] + end - starts[last] if copied(last, b) else b[1]
            source = text[source_start:source_end]
            if kind == "email" and not _believed(source, clean[start:end].rpartition(".")[2]):
                continue
            if kind == "email":  # a word that begins with letters beyond ASCII is taken whole
                while source_start and text[source_start - 1].isalnum():
                    source_start -= 1
                source = text[source_start:source_end]
            lead = len(source) - len(source.lstrip())
            found.append((kind, source_start + lead, source_end - (len(source) - len(source.rstrip()))))
    return found


def find(text: str) -> list[Span]:
    """All spans of personal data, by start, then kind as in KINDS. An empty text has none."""
    spans: list[Span] = [(kind, a, b, True) for kind, detect in _DETECTORS.items() for a, b in detect(text)]
    if _worth(text):
        taken = {kind: [(a, b) for k, a, b, _ in spans if k == kind] for kind in KINDS}
        for kind, a, b in _disguised(text):
            if all(b <= x or y <= a for x, y in taken[kind]):
                spans.append((kind, a, b, False))
                taken[kind].append((a, b))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))
