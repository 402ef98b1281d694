"""Problem 3: personal data in free text, found on a normalised copy and mapped back to the source.

A chain of transducers rewrites disguises: full-width and look-alike characters and digits one for one, letters that
stand for digits inside numbers, digits spelled as words, and at/dot disguises of mail addresses. Each rewriting keeps
the source position of every character, so a span found in the normalised text is a span of the source.

Identifiers are found by shape and number plan, with the words before them that make a number an order, lot or invoice
number. Names are found by what the corpus says: words that stand first in many typed names are given names (`lore`), words
that texts write in lower case are vocabulary; a given name beside a word of no vocabulary is a name in any order and case,
and so are, within a sentence, two capitalised words of no vocabulary that are no company, street or town.

Defined cases: null, empty and blank texts have no case; equal texts in different rows have their own cases; a record
delivered again gives the same rows, which are distinct in the queries. Where spans overlap the first in the order
e-mail, identity number, phone, address, name stands.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .lore import LEGAL, Lore, folded, learn

TITLES = r"(?:(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sr|Sra|Mme|Mlle|Herr|Frau|Sig|Dott|Bay|Bayan)\.?\s+)"
#: Words of companies, departments and rooms that a person's name has not (fixed values; trades are learned beside them).
SMALL = frozenset("the and as sa ag sl".split())
COMPANY = (LEGAL - SMALL) | frozenset("dept claims desk room rm file copy all branches accounts payable records office intake".split())
#: Words whose numbers are business numbers (fixed values).
BUSINESS = re.compile(
    r"(?:order|invoice|ref|reference|lot|part|batch|serial|item|pedido|factura|commande|facture|auftrag|rechnung|bestellung|ordine|fattura|sipariş|fatura|parti|lote|lotto|p/n|po|claim)s?\b\.?[\s:#]*(?:no|nr|n[°º.]|num|number|numarası|numéro|número|numero)?\b[.:#°º]*\s*$",
    re.IGNORECASE,
)
FLAT = {i: chr(i - 0xFEE0) for i in range(0xFF01, 0xFF5F)} | {0x3000: " ", 0xA0: " ", 0x2007: " ", 0x202F: " ", 0x2010: "-", 0x2011: "-", 0x2012: "-", 0x2013: "-", 0x2212: "-"}
FLAT |= {base + d: str(d) for base in (0x660, 0x6F0, 0x966) for d in range(10)}
#: Cyrillic and Greek letters that look like Latin ones (fixed values).
FLAT |= dict(zip(map(ord, "аеорсухіјѕАВЕКМНОРСТХІЈοΑΒΕΗΙΚΜΝΟΡΤΧ"), "aeopcyxijsABEKMHOPCTXIJoABEHIKMNOPTX"))
#: Digits as words of the six languages (fixed values).
DIGIT_WORDS = {
    w: str(d)
    for d, ws in enumerate(
        (
            "zero oh zéro null cero sıfır", "one un une eins ein uno bir", "two deux zwei zwo dos iki due", "three trois drei tres üç tre", "four quatre vier cuatro dört quattro",
            "five cinq fünf cinco beş cinque", "six sechs seis altı sei", "seven sept sieben siete yedi sette", "eight huit acht ocho sekiz otto", "nine neuf neun nueve dokuz nove",
        )
    )
    for w in ws.split()
}
DIGIT_WORD = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
SPELLED = re.compile(rf"\b{DIGIT_WORD}(?:[\s-]+{DIGIT_WORD}){{4,}}\b", re.IGNORECASE)
LETTER_DIGIT = re.compile(r"(?<=[\d(+])[OoIl](?=[\d ]*\d)|(?<=\d[ .-])[OoIl](?=[OoIl]*\d)|\b[OoIl](?=\d{2,}\b)")
AT = re.compile(r"(?<=[\w+-])\s*(?:[\[({<]\s*(?:at|arroba|chiocciola|arobase)\s*[\])}>]|@)\s*(?=[A-Za-z0-9])", re.IGNORECASE)
AT_WORD = re.compile(r"(?<=\w) (?:at) (?=[\w-]+ (?:dot) \w)", re.IGNORECASE)
DOT = re.compile(r"(?<=\w)\s*[\[({<]\s*(?:dot|punto|point|punkt|nokta)\s*[\])}>]\s*(?=\w)| (?:dot) (?=[a-z]{2,}\b)", re.IGNORECASE)

EMAIL = re.compile(r"[A-Za-z0-9](?:[\w.+-]*[A-Za-z0-9_])?@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
ID = re.compile(
    r"(?<![\w.,/+-])(?:"
    r"\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}"
    r"|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]"
    r"|[XYZ]-?\d{7}-?[A-Z]|[A-Z]\d{8}|[A-Z]{2} ?\d{7}|\d{2}[A-Z]{2}\d{5}"
    r"|\d{8}-?[A-Z]|\d{2}\.\d{3}\.\d{3}-?[A-Z]"
    r"|\d ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3} ?\d{2}"
    r"|\d{11}|\d{3} \d{3} \d{3} \d{2}|\d{2} \d{3} \d{3} \d{3}"
    r"|\d{2}-\d{7}"
    r"|[A-Za-z]{6}\d{2}[A-Za-z]\d{2}[A-Za-z]\d{3}[A-Za-z]"
    r"|(?<=SSN )\d{9}|(?<=SSN: )\d{9}"
    r")(?![\w/]|[-.,]\d)"
)
PHONE = re.compile(r"(?<![\w.,/+(-])(?:\+ ?\d|\(\+?\d|\d)(?:\d|[ .\-/]\d|\) ?[-/]?\d| ?\(\d|\)[ -]?\(?\d){5,18}(?![\w/]|[-.,]\d)")
CAP = r"[A-ZÀ-ÖØ-ÞĞİŞŒ]"
CAPS = r"[A-ZÀ-ÖØ-ÞĞİŞŒa-zß-öø-ÿğışœ]"
WORDC = r"[\w'’.-]"
ADDRESS = re.compile(
    r"(?<![\w/-])(?:"
    # box numbers
    r"(?:P\. ?O\. ?|PO )Box \d+|B\. ?P\. ?\d+|BP \d+|Postfach \d+|(?:Apdo\.?|Apartado)(?: de Correos)? \d+|Casella [Pp]ostale \d+|C\.P\. \d+|P\. ?K\. ?\d+|Posta Kutusu \d+"
    # number, name, street type
    rf"|(?:(?:Flat|Apt|Apartment|Unit|Suite|Ste)\.? ?\d+[A-Za-z]?,?\s+)?\d{{1,5}}[A-Za-z]?,? (?:{CAP}{WORDC}*\s){{1,3}}(?:Road|Street|Lane|Avenue|Court|Drive|Close|Way|Square|Terrace|Crescent|Boulevard|Place|Rd|St|Ave|ROAD|STREET|LANE|AVENUE|COURT)\b"
    # number, street type, name
    r"|\d{1,5}(?: ?(?:bis|ter))?,? (?:rue|avenue|boulevard|chemin|place|allée|impasse|quai|route|cours|square|RUE|AVENUE|BOULEVARD|CHEMIN) (?:d[eu]s?|l[ae]|[\w'’-]{3,})"
    # one word with street type, number
    rf"|{CAP}[\w-]*(?:straße|strasse|str\.|gasse|weg|platz|allee|ufer|ring|damm|STRASSE|GASSE|WEG|PLATZ) \d{{1,4}} ?[a-z]?\b"
    rf"|(?:Am|An der|An den|Im|In der|Auf dem|Auf der|Zum|Zur|AM|IM) (?:{CAP}[\w-]+ ){{1,3}}\d{{1,3}}[a-z]?\b"
    # street type, name, number
    r"|(?:Calle|C/|Avda\.?|Avenida|Plaza|Paseo|Camino|Ronda|Travesía|Via|Viale|Piazza|Corso|Largo|Vicolo|Piazzale|Strada|CALLE|PLAZA|VIA|VIALE|PIAZZA)\s(?:[\w'’]+\s){0,4}(?!fax\b)[\w'’]+,? (?:n[.º°]+ ?)?\d{1,4}(?!\d|/\d)"
    # name, street type
    rf"|(?:{CAP}[\w'’]+ ){{1,3}}(?:Mah\.|Mahallesi|Cad\.|Caddesi|Sok\.|Sokağı|Sokak|Bulvarı|MAH\.|CAD\.|SOK\.|SOKAĞI)(?= |,|\n)"
    r")"
)
#: What follows the first part of an address: the rest of the street's name, numbers of flats, post code and town.
POST_CODE = r"(?:(?:[A-Z]{1,2}-)?\d{4,5}(?![\d-])|[A-Z]{1,2}\d[\dA-Z]? \d[A-Z]{2}\b)"
TOWN = rf"{CAP}[^\W\d_]+(?!\w)(?:[- '’]{CAP}[^\W\d_]+(?!\w)){{0,3}}"
TAIL = re.compile(
    r"(?:,? (?:Flat|Apt|Apartment|Unit|Suite|Ste|Kat|Daire|No|n[.º°]|piso|esc)[.:]? ?\d+[\w./-]*|,? \d{1,4}(?: ?[a-z]\b)?(?:/\d+)?(?![\d-])|, \d{1,2}\.º ?[A-Z]?|:\d[\w./-]*"
    rf"|[ '’](?:d[eu]s?|l[ae]s?|[dl]['’]{CAP}[\w'’]+)\b|(?:(?<=de)|(?<=des)|(?<=du)|(?<=la)|(?<=les)|(?<=le)) {CAP}[\w'’-]+){{0,8}}"
    rf"(?:(?:,? ?\n ?|, ?| ){POST_CODE}(?:(?: |,? ?\n ?|, ?){TOWN})?|(?:, ?|,? ?\n ?){TOWN}(?:(?:,? ?\n ?|, ?| ){POST_CODE})?)?"
)
STREET_WORDS = re.compile(
    r"Box|B\. ?P|BP |Postfach|Apdo|Apartado|asella|C\.P|P\. ?K|Kutusu|Road|Street|Lane|venue|Court|Drive|Close|Square|Terrace|Crescent|oulevard|Rd|rue |chemin|place |allée|impasse|quai|route|cours|stra(?:ß|ss)e|str\.|gasse|weg |platz|allee|ufer|ring |damm|Am |An d|Im |In d|Auf d|Zu[mr] |Calle|C/|Avda|Avenida|Plaza|Paseo|Camino|Ronda|Via|Piazz|Corso|Largo|Vicolo|Strada|Mah|Cad|Sok|Bulvar|ROAD|STREET|LANE|AVENUE|COURT|RUE|BOULEVARD|CHEMIN|STRASSE|GASSE|CALLE|PLAZA|VIA|PIAZZ|MAH|CAD|SOK"
)

TOKEN = re.compile(r"[^\W_][\w'’-]*")
INITIAL = re.compile(rf"(?<![\w.'’-])(?:{CAP}\. ?(?:{CAP}\. ?)?)({CAP}[\w'’-]{{4,}})")
BEFORE = re.compile(rf"(?<![\w'’.@-])({CAP}[a-zß-öø-ÿğışœ]{{3,}}) $")
SURNAME_INITIAL = re.compile(rf"(?<![\w'’.-])({CAP}[\w'’-]{{4,}}), ({CAP}\.?)(?: ?{CAP}\.?)?(?![\w'’-])")
WHOLE = re.compile(rf"^\s*(?:(?:Attn|Att|c/o|cc|To|From)\b[.:]?\s*)?{TITLES}?(?P<name>[^\W\d_][^\n;:/()<>]*)", re.IGNORECASE)
DIGIT = re.compile(r"\d")
NICK = re.compile(r"\s*[\"“”'‘’(][^\"“”'‘’()]{2,15}[\"“”'‘’)]\s*")


def shortened(w: str) -> set[str]:
    return {w[:i] + w[i + 1 :] for i in range(len(w))}


class Mapped:
    """A normalised text with the source position of each of its positions; no list where none has moved."""

    def __init__(self, text: str):
        self.text = text
        self.at: list[int] | None = None

    def rewrite(self, pattern: re.Pattern, to) -> None:
        """Every match replaced; what replaces it stands where the match began, what follows where it stood."""
        out: list[str] = []
        at: list[int] = []
        last = 0
        for m in pattern.finditer(self.text):
            old = self.at or range(len(self.text) + 1)
            new = to(m) if callable(to) else to
            out += [self.text[last : m.start()], new]
            at += [*old[last : m.start()], *[old[m.start()]] * len(new)]
            last = m.end()
        if out:
            old = self.at or range(len(self.text) + 1)
            out.append(self.text[last:])
            self.at = [*at, *old[last:]]
            self.text = "".join(out)

    def source(self, at: int) -> int:
        return at if self.at is None else self.at[at]


def normalised(text: str) -> tuple[Mapped, list[str]]:
    """The text without disguises, and its words of three letters and more."""
    m = Mapped(text.translate(FLAT) if not text.isascii() and FLAT_HINT.search(text) else text)
    t = m.text
    words = LETTERS.findall(t)
    if "@" in t or "at]" in t or "at)" in t or "AT]" in t or "AT)" in t or " dot " in t:
        m.rewrite(DOT, ".")
        m.rewrite(AT, "@")
        m.rewrite(AT_WORD, "@")
    if sum(map(SPELLS.__getitem__, words)) >= 3:
        m.rewrite(SPELLED, lambda x: "".join(DIGIT_WORDS.get(w.lower()) or FOLDED_DIGITS[fold(w)] for w in re.split(r"[\s-]+", x[0])))
    if DIGIT.search(t):
        m.rewrite(LETTER_DIGIT, lambda x: "0" if x[0] in "Oo" else "1")
    return m, words


FOLDED_DIGITS = {folded(w): d for w, d in DIGIT_WORDS.items()}


class Memo(dict):
    """Values by word; when full it starts afresh."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, w: str):
        if len(self) > 200_000:
            self.clear()
        self[w] = v = self.make(w)
        return v


#: Words by their folded form.
FOLDED = Memo(folded)
fold = FOLDED.__getitem__
#: 1 for words that spell a digit.
SPELLS = Memo(lambda w: int(folded(w) in FOLDED_DIGITS))
FLAT_HINT = re.compile("[" + re.escape("".join(map(chr, FLAT))) + "]")
GROUPS = re.compile(r"\d+")


def is_phone(t: str) -> bool:
    """Whether a run of digits and dividers is a phone number of some plan: international by its length; with an area in
    brackets; national with a trunk 0 or a mobile 3 or 5 of nine to twelve digits; ten digits of North America, divided
    3-3-4 or not at all, a 1 before them or not; nine of Spain in threes or pairs; seven, a dash after the third."""
    digits = "".join(c for c in t if c.isdigit())
    n = len(digits)
    if t[0] == "+":
        return 8 <= n <= 15
    if "(" in t:
        return 9 <= n <= 13
    sizes = [len(g) for g in GROUPS.findall(t)]
    if digits.startswith("00") and 11 <= n <= 15 and "-" not in t[:3]:
        return True
    if digits[0] == "0":
        return 9 <= n <= 12 and len(sizes) > 1 and min(sizes) >= 2 and not (n == 11 and sizes == [3, 3, 3, 2])
    if n == 10 and (sizes in ([10], [3, 3, 4]) or digits[0] in "35" and sizes in ([3, 7], [4, 6], [3, 3, 2, 2])):
        return True
    if n == 11 and digits[0] == "1":
        return sizes in ([1, 3, 3, 4], [11])
    if n == 9:
        return digits[0] in "6789" and sizes in ([3, 3, 3], [3, 2, 2, 2], [2, 3, 2, 2])
    return n == 7 and sizes == [3, 4] and "-" in t


def fits(given: str, other: str) -> bool:
    """Whether the letter case of a surname goes with that of the given name."""
    if given[0].islower():
        return other[0].islower()
    return other[0].isupper()


class Finder:
    """Finds personal data in a text, with a vocabulary and the lore of names."""

    def __init__(self, vocabulary: frozenset[str], lore: Lore | None = None):
        lore = lore or Lore()
        self.vocabulary = vocabulary
        self.short = lore.short
        self.given = frozenset(lore.given) - lore.short
        self.company = COMPANY | frozenset(lore.trades)
        #: 1 for capitalised words that could be part of a name.
        self.odd = Memo(lambda w: int(w[0].isupper() and w.lower() not in self.vocabulary and w.lower() not in self.company))
        #: A word is near a given name if both share a form with one letter left out.
        self.near = frozenset(x for n in self.given if len(n) >= 5 for x in shortened(n) | {n})

    def near_given(self, w: str) -> bool:
        for one in ("l", "i") if "1" in w else ("",):
            f = fold(w.replace("0", "o").replace("1", one).replace("@", "a").replace("3", "e"))
            if f in self.given or f in self.short or (len(f) >= 4 and (f in self.near or not self.near.isdisjoint(shortened(f)))):
                return True
        return False

    def surname(self, w: str) -> bool:
        low = w.lower()
        return len(w) >= 4 and low not in self.vocabulary and low not in self.company and any(c.isalpha() for c in w) and sum(map(str.isdigit, w)) <= 2

    def unlisted(self, t: str, taken: list[tuple[int, int]], addresses: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Names whose given name the corpus does not tell: within a sentence two or three capitalised words of no
        vocabulary, a middle initial allowed, that are no company, and no town behind an address."""
        out = []
        for m in PAIR.finditer(t):
            words = [w for w in re.split(r"[ .]+", m[0]) if len(w) > 1]
            if len(words) < 2 or any(not self.surname(w) and not (len(w) == 3 and w.lower() not in self.vocabulary and w.lower() not in self.company) for w in words):
                continue
            a, b = m.span()
            if any(x < b and a < y for x, y in taken) or any(y <= a and not t[y:a].strip(" ,\n0123456789") for _, y in addresses):
                continue
            after = TOKEN.match(t, b + 1)
            if after and t[b : b + 1] == " " and after[0].lower() in self.company:
                continue
            line = t[t.rfind("\n", 0, a) + 1 : (t.find("\n", b) + 1 or len(t) + 1) - 1]
            if len(LOWER.findall(line)) >= LEAST_LOWER:
                out.append((a, b))
        return out

    def names(self, t: str, whole: bool, party: bool = False) -> list[tuple[int, int]]:
        tokens = [(m[0], m.start(), m.end()) for m in TOKEN.finditer(t)]
        out: list[tuple[int, int]] = []
        n = len(tokens)
        for i, (w, a, b) in enumerate(tokens):
            f = fold(w)
            if f not in self.given and not (f in self.short and w[0].isupper() and len(w) > 1):
                continue
            if (a and t[a - 1] in "._+@") or (b < len(t) and t[b] in "._@+" and b + 1 < len(t) and t[b + 1].isalnum()):
                continue
            if out and a < out[-1][1]:
                continue
            j, end = i + 1, b
            gap = t[b : tokens[j][1]] if j < n else ""
            if j < n and NICK.fullmatch(t[b : tokens[j][2] + 2]) and j + 1 < n:  # given "short" surname
                j += 1
                gap = " "
            for _ in range(2):  # middle initials
                if j < n and j + 1 < n and len(tokens[j][0]) == 1 and gap.isspace() and tokens[j][0].isupper():
                    gap = t[tokens[j][2] : tokens[j + 1][1]].lstrip(".") or " "
                    j += 1
            if j < n and gap.isspace() and "\n\n" not in gap and "\n" not in gap[:1] + gap[-1:] and self.surname(tokens[j][0]) and fits(w, tokens[j][0]) and fold(tokens[j][0]) not in self.given:
                end = tokens[j][2]
                out.append((a, end))
                continue
            if i:
                pw, pa_, pb = tokens[i - 1]
                between = t[pb:a]
                if between.strip() in ("", ",") and len(between) <= 3 and "\n" not in between and self.surname(pw) and (between.strip() or pw.isupper() or whole) and (pw[0].isupper() == w[0].isupper()) and not (out and pa_ < out[-1][1]):
                    stop = b
                    if m := re.match(r" [^\W\d_]\.", t[b : b + 3]):
                        stop = b + m.end()
                    out.append((pa_, stop))
        if "." in t or whole:
            for m in INITIAL.finditer(t):
                if self.surname(m[1]) and not any(a < m.end() and m.start() < b for a, b in out):
                    before = BEFORE.search(t, 0, m.start())
                    out.append((before.start(1) if before and self.surname(before[1]) else m.start(), m.end()))
            for m in SURNAME_INITIAL.finditer(t):
                if self.surname(m[1]) and (m[2].endswith(".") or whole) and not any(a < m.end() and m.start() < b for a, b in out):
                    out.append(m.span())
        if whole and not out and (m := WHOLE.match(t)):
            s = m.start("name")
            words = [x for x in TOKEN.finditer(t, s, m.end("name"))]
            text_words = [x[0] for x in words if len(x[0]) > 1]
            initials = [x[0] for x in words if len(x[0]) == 1]
            lows = [x.lower() for x in text_words]
            if 1 <= len(text_words) <= 4 and not self.company.intersection(lows[:3]):
                if any(x.isdigit() for x in lows) or len(text_words) > 3 and not any(fold(x) in self.given for x in text_words):
                    pass
                elif len(text_words) >= 2 and any(self.near_given(x) for x in text_words[:2]) and any(self.surname(x) and not self.near_given(x) for x in text_words[:3]):
                    out.append((s, words[-1].end()))
                elif party and 2 <= len(text_words) <= 3 and all(self.surname(x) or len(x) < 4 for x in text_words) and max(map(len, text_words)) >= 7:
                    out.append((s, words[-1].end()))
                elif len(text_words) == 1 and initials and self.surname(text_words[0]) and len(words) <= 3 and len(text_words[0]) >= 5:
                    out.append((s, words[-1].end()))
        return out

    def find(self, source: str, field: str | None = None) -> list[tuple[str, int, int]]:
        """(kind, start, end) in the source, by start. field: the key of a form field whose value the text is."""
        phone_field = field in ("phone", "fax")
        m, words = normalised(source)
        t = m.text
        out: list[tuple[str, int, int]] = []
        free = lambda a, b: all(b <= x or y <= a for _, x, y in out)
        if "@" in t:
            out.extend(("email", *x.span()) for x in EMAIL.finditer(t))
        digits = DIGIT.findall(t)
        if len(digits) >= 6:
            for x in ID.finditer(t):
                if free(*x.span()) and not BUSINESS.search(t, max(0, x.start() - 24), x.start()):
                    out.append(("id_number", *x.span()))
            for x in PHONE.finditer(t):
                if free(*x.span()) and is_phone(x[0]) and not BUSINESS.search(t, max(0, x.start() - 24), x.start()):
                    out.append(("phone", *x.span()))
        if phone_field and not any(k in ("phone", "id_number") for k, _, _ in out):
            if len(digits) >= 6 and (x := re.search(r"[+(]*\d[\d .\-/()]*\d", t)):
                out.append(("phone", *x.span()))
        elif phone_field:
            out = [("phone", a, b) if k == "id_number" else (k, a, b) for k, a, b in out]
        if digits and STREET_WORDS.search(t):
            for x in ADDRESS.finditer(t):
                if free(*x.span()):
                    out.append(("address", *x.span()))
        whole = "\n" not in t.strip() and t.count(" ") < WHOLE_WORDS
        if whole or not self.given.isdisjoint(map(fold, words)) or (". " in t and INITIAL.search(t)):
            out.extend(("name", a, b) for a, b in self.names(t, whole and (len(digits) < 5), field in ("to", "from")) if free(a, b))
        if sum(map(self.odd.__getitem__, words)) >= 2:
            out.extend(("name", a, b) for a, b in self.unlisted(t, [x[1:] for x in out], [x[1:] for x in out if x[0] == "address"]))
        out.sort(key=lambda x: x[1])
        for i, (k, a, b) in enumerate(out):
            if k == "address":  # to the end of its town, or to the next case
                stop = out[i + 1][1] if i + 1 < len(out) else len(t)
                end = TAIL.match(t, b).end()
                out[i] = k, a, b if end > stop else end
        return [(k, m.source(a), m.source(b)) for k, a, b in out]


#: Lower-case words that make a line a sentence; a text of one line with fewer words than WHOLE_WORDS may be one name.
LEAST_LOWER = 2
WHOLE_WORDS = 9
LOWER = re.compile(r"(?<![^\s(«\"“„])[^\W\d_A-ZÀ-ÖØ-ÞĞİŞŒ]{2,}(?![^\s.,;:?!)»\"”])")
PAIR = re.compile(rf"(?<![\w'’.@-]){CAP}[a-zß-öø-ÿğışœ'’]{CAPS}*(?:-{CAP}[a-zß-öø-ÿğışœ]+)? (?:{CAP}\.? )?{CAP}[a-zß-öø-ÿğışœ'’]{CAPS}*(?:-{CAP}[a-zß-öø-ÿğışœ]+)?(?: {CAP}[a-zß-öø-ÿğışœ]+)?(?![\w@-])")
LETTERS = re.compile(r"[^\W\d_]{3,}")


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    out, last = [], 0
    for kind, a, b in found:
        if a >= last:
            out += [text[last:a], f"[{kind.upper()}]"]
            last = max(a, b)
    return "".join([*out, text[last:]])


def personal_data(rows: DataFrame, known: tuple[frozenset[str], Lore], row_id: str, text: str, field: str | None = None) -> DataFrame:
    """row_id, kind, start_pos, end_pos of every case in a text column; one narrow pass. known: vocabulary and lore of
    names; field: a column with the key of the form field whose value the text is."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(*shared.value).find
        for b in batches:
            at, kinds, starts, ends = [], [], [], []
            flags = b.column(2).to_pylist() if field else None
            for i, t in enumerate(b.column(1).to_pylist()):
                if t:
                    for k, s, e in find(t, flags[i] if flags else None):
                        at.append(i)
                        kinds.append(k)
                        starts.append(s)
                        ends.append(e)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=["row_id", "kind", "start_pos", "end_pos"])

    return rows.select(row_id, text, *([field] if field else [])).mapInArrow(run, "row_id bigint, kind string, start_pos int, end_pos int")


def redact(rows: DataFrame, known: tuple[frozenset[str], Lore], keep: tuple[str, ...], text: str, field: str | None = None) -> DataFrame:
    """The `keep` columns and `redacted`: the text with a typed placeholder for each case; null stays null."""
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(*shared.value).find
        n = len(keep)
        for b in batches:
            flags = b.column(n + 1).to_pylist() if field else None
            new = [redacted(t, find(t, flags[i] if flags else None)) if t else t for i, t in enumerate(b.column(n).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(new, pa.string())], names=[*keep, "redacted"])

    picked = rows.select(*keep, text, *([field] if field else []))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[: len(keep)])
    return picked.mapInArrow(run, f"{kept}, redacted string")


#: A word is vocabulary if texts write it in lower case this share of all words (so it has at most 1 / share words) and this
#: often, and at least this part of the times they write it with a capital.
LEAST_WORD_SHARE, LEAST_WORD_COUNT, LOWER_PART = 1.2e-5, 3, 0.1


def vocabulary(dictionary: DataFrame, texts: DataFrame | None = None) -> frozenset[str]:
    """The terms of the dictionary table, whose size is fixed, and what a column `text` writes in lower case, mail addresses
    and the like apart; counted over all texts."""
    terms = frozenset(r[0] for r in dictionary.select("term").distinct().collect() if r[0])
    if texts is None:
        return terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            low, high = Counter(), Counter()
            for chunk, n in chunks.items():
                bare = chunk.strip(".,;:!?()\"“”„«»'’")
                if bare.isalpha():
                    (low if bare[0].islower() else high)[bare.lower()] += n
            chunks.clear()
            words = list(low | high)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([low[w] for w in words], pa.int64()), pa.array([high[w] for w in words], pa.int64())], names=["word", "low", "high"])

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    chunks.update(t.split())
            if len(chunks) > 300_000:
                yield flush()
        yield flush()

    counted = written(texts.select("text").mapInArrow(run, "word string, low bigint, high bigint").groupBy("word").agg(F.sum("low").alias("low"), F.sum("high").alias("high")), "pii-words")
    total = counted.agg(F.sum(F.col("low") + F.col("high"))).first()[0] or 0
    least = max(LEAST_WORD_COUNT, int(total * LEAST_WORD_SHARE))
    return terms | frozenset(r.word for r in counted.filter((F.col("low") >= least) & (F.col("low") >= LOWER_PART * F.col("high"))).select("word").collect())


def known_of(dictionary: DataFrame, texts: DataFrame, fields: DataFrame) -> tuple[frozenset[str], Lore]:
    """Vocabulary and lore from all texts (column `text`) and from the typed senders and recipients of `fields`."""
    return vocabulary(dictionary, texts), learn(fields.filter(F.col("field_key").isin("to", "from")))
