"""Problem 3: e-mail addresses, phone and identity numbers, street addresses and names in free text.

Anchor expansion.  One pass of an Aho-Corasick automaton over a message finds the anchors: at-signs
and their spellings, schemes, words that announce a number, an address or a name, and street words;
runs of digits are anchors of their own.  From an anchor a local parser expands to the left and
right, as far as the characters of its kind reach and never by a fixed window, and checks what it
finds: an address needs a domain with a final label, a number the right count and grouping of
digits, a street a house number, a name one to four words of letters.  Account, card and identity
numbers are validated by their check digits (bank accounts modulo 97, cards by Luhn, six national
schemes) and then need no cue; dates, times, network addresses, book numbers, amounts and what
follows a word such as order or version are none.  Digits inside of a URL are part of it.  A message
without any anchor is left after that one pass.

Names are found by what stands beside them: words by which people introduce themselves or sign,
verbs of sending and signing, forms of address, greetings, sign-offs, and other findings.

What is found is replaced by a typed placeholder and every other character stays as it was.
Positions hold in the original text, as the form that is searched has the same length.

Defined results: a null message stays null and holds nothing; of overlapping findings the earlier
and longer one wins; a name inside an e-mail address or a street is none; a repeated id is one
record.  Block lists keep their JSON text, spacing and escapes, with the placeholders inside their texts.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "phone", "id_number", "address", "name")
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}

# Words that announce what follows, by kind.
PHONE_CUES = (
    "call me on;call me at;my number is;if it is urgent, text;urgent, text;phone;tel.;tel;telephone;mobile;ring me;fax;"
    "ruf mich;nummer lautet;im notfall bitte;telefon;handy;appelez-moi au;mon numéro est;composez le;téléphone;"
    "llámame al;mi número es;marca el;teléfono;o meu número é;liga-me para;urgente, marca;telefone;telemóvel;"
    "il mio numero è;chiamami al;componi il;telefono;cellulare;обади ми се на;номерът ми е;набери;телефон;"
    "мой номер;позвони мне по номеру;رقمي هو;اتصل بي على;فاطلب;هاتف;我的号码是;请打;电话;手机;请拨"
).split(";")
ID_CUES = (
    "passport;national id;id number;social security;tax office;tax id;identity card;id;passnummer;ausweisnummer;reisepass;finanzamt;steuernummer;"
    "passeport;carte d'identité;le fisc;pasaporte;documento de identidad;hacienda;dni;passaporte;cartão de cidadão;as finanças;"
    "passaporto;carta d'identità;il fisco;codice fiscale;паспорта;егн;данъчните;удостоверение личности;налоговой;лична карта;"
    "جوازي;رقم الهوية;ملفي الضريبي;护照;身份证;税务局;编号"
).split(";")
#: Before a name: how people introduce themselves and sign; with it what ends the name besides the end of
#: the sentence.
NAME_CUES = {
    "my name is": r"and\b", "i am called": r"and\b", "signed by": "", "mein name ist": r"und\b", "ich heiße": r"und\b", "unterschrieben von": "", "je m'appelle": r"et\b", "mon nom est": r"et\b",
    "signé par": "", "me llamo": r"y\b", "mi nombre es": r"y\b", "lo firmó": "", "firmado por": "", "chamo-me": r"e\b", "o meu nome é": r"e\b", "meu nome é": r"e\b", "assinado por": "", "mi chiamo": r"e\b",
    "il mio nome è": r"e\b", "firmato da": "", "казвам се": r"и\b", "името ми е": r"и\b", "подписан от": "", "меня зовут": r"и\b", "моё имя": r"и\b", "подпись:": "", "подписал": "", "اسمي": r"و[أن]\w+", "وقع الاستمارة": "",
    "我叫": "正在", "我的名字是": "正在",
}
#: Verbs of handing on, the word between them and the name, and what ends the name.
SEND_CUES = {
    "forward ": (r"\bto ", r"today\b|by\b"), "send this": (r"\bto ", r"today\b|by\b"), "pass this": (r"\bto ", r"today\b|by\b"), "transmettre": (r"\bà ", "aujourd"), "faire suivre": (r"\bà ", "aujourd"),
    "reenvía": (r"\ba ", r"por\b"), "envía esto": (r"\ba ", r"por\b"), "encaminha": (r"\bpara ", r"por\b"), "envia isto": (r"\bpara ", r"por\b"), "inoltra": (r"\ba ", r"per\b"), "препрати": (r"\bна ", ""), "получатель": (r"", ""),
    "تحويل": (r"\bإلى ", ""), "转交给": (r"", ""), "转发给": (r"", ""),
}
#: Words after a name, and the word before it: das Formular hat ... unterschrieben.
NAME_ENDS = {"unterschrieben": " hat ", "weiterleiten": " an ", "签名": "由", "签字": "由"}
#: Forms of address; one to three names in capitals follow, in scripts without capitals one.
TITLES = "mr. ;mr ;mrs. ;mrs ;ms. ;dr. ;prof. ;herr ;frau ;monsieur ;madame ;mme ;señor ;señora ;sra. ;senhor ;senhora ;signor ;signora ;sig. ;г-н ;г-жа ;господин ;госпожа ;السيد ;السيدة ".split(";")
#: Verbs of contact and greetings; two or three names in capitals follow.
CONTACTS = (
    "talk to ;talked to ;talking to ;spoke to ;spoke with ;speak with ;speak to ;met with ;i met ;contact ;dear ;hello ;hi ;"
    "sprach mit ;spreche mit ;gesprochen mit ;kontaktieren sie ;liebe ;lieber ;geehrte ;geehrter ;hallo ;parlé à ;parlé avec ;rencontré ;contactez ;cher ;chère ;bonjour ;"
    "hablé con ;hablar con ;conocí a ;contacta a ;contacte a ;querido ;querida ;hola ;falei com ;falar com ;conheci ;contacte ;caro ;cara ;olá ;parlato con ;parlare con ;incontrato ;contatta ;contatti ;ciao ;"
    "говорих с ;говоря с ;срещнах ;свържете се с ;скъпи ;скъпа ;здравей ;говорил с ;говорила с ;встретил ;встретила ;свяжитесь с ;дорогой ;дорогая ;уважаемый ;уважаемая ;привет "
).split(";")
#: At the end of a letter, before its signature.
SIGN_OFFS = (
    "best,;regards,;sincerely,;yours,;cheers,;freundlichen grüßen;viele grüße;liebe grüße;cordialement,;bien à vous,;un saludo,;saludos,;atentamente,;cumprimentos,;atenciosamente,;"
    "cordiali saluti,;saluti,;поздрави,;с уважение,;с уважением,;مع التحية;此致敬礼"
).split(";")
STREETS_AFTER = "street avenue lane road court drive square close boulevard terrace crescent".split()  # 12 Mill Lane, Mill Lane 12
STREETS_JOINED = "gasse straße strasse allee steg weg platz bruch ufer damm".split()  # Alte Färbergasse 7
STREETS_BEFORE = (
    "rue avenue impasse quai chemin boulevard place calle avenida plaza paseo travesía camino rua travessa calçada largo praça via viale piazza corso vicolo"
).split()  # 12, rue des Tilleuls; calle del Olmo 7
STREETS_CYRILLIC = ("ул.", "бул.", "пр.", "пер.", "наб.", "просп.", "ж.к.", "пл.")
STREETS_ARABIC = ("شارع", "طريق", "زقاق", "ساحة", "حارة")
STREETS_HAN = ("路", "街", "巷", "大道", "弄")

_A = ahocorasick.Automaton()


def _anchor(word: str, what: str) -> None:
    _A.add_word(word, _A.get(word, ()) + ((what, word),))


for _w in ("@", "(at)", "[at]"):
    _anchor(_w, "email")
_anchor("://", "url")
for _w in PHONE_CUES:
    _anchor(_w, "phone")
for _w in ID_CUES:
    _anchor(_w, "id")
for _what, _words in (("name", NAME_CUES), ("send", SEND_CUES), ("end", NAME_ENDS), ("title", TITLES), ("contact", CONTACTS), ("off", SIGN_OFFS)):
    for _w in _words:
        _anchor(_w, _what)
for _kind, _words in (
    ("after", [" " + w for w in STREETS_AFTER]), ("joined", [w + " " for w in STREETS_JOINED]), ("am", [" am "]), ("before", [w + " " for w in STREETS_BEFORE]),
    ("cyrillic", STREETS_CYRILLIC), ("arabic", STREETS_ARABIC), ("han", STREETS_HAN),
):
    for _w in _words:
        _anchor(_w, "street-" + _kind)
for _w in ("—", "–", ">"):
    _anchor(_w, "sign")
_A.make_automaton()

_FOLD = str.maketrans(
    {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
    | {chr(z + i): str(i) for z in (0x660, 0x6F0) for i in range(10)}
    | {c: " " for c in "              　"}
    | {"’": "'", "‐": "-", "‑": "-", "−": "-"}
)
_FOLDED = re.compile("[  -   　٠-٩۰-۹！-～’‐‑−]")


def _fold(text: str) -> str:
    """The text with plain digits, spaces and widths; of the same length."""
    return text.translate(_FOLD) if not text.isascii() and _FOLDED.search(text) else text


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.+-")
_DOMAIN = re.compile(r"[A-Za-z0-9\-]+(?:(?:\s?\[dot\]\s?|\s?\(dot\)\s?|\.)[A-Za-z0-9\-]+)*(?:\s?\[dot\]\s?|\s?\(dot\)\s?|\.)[A-Za-z]{2,}")


def _email(text: str, start: int, end: int) -> tuple[int, int] | None:
    """An address around an at-sign at start:end, as far as its characters reach on either side."""
    stop = start
    while stop > 0 and text[stop - 1] == " " and start - stop < 2:
        stop -= 1
    first = stop
    while first > 0 and text[first - 1] in _LOCAL:
        first -= 1
    while first < stop and text[first] in ".+-":
        first += 1
    if first == stop:
        return None
    at = end
    while at < len(text) and text[at] == " " and at - end < 2:
        at += 1
    domain = _DOMAIN.match(text, at)
    return (first, domain.end()) if domain else None


_URL = re.compile(r"[^\s<>\"'）)\]]+")


def _url(text: str, start: int) -> tuple[int, int]:
    """The URL around a scheme's colon and slashes."""
    first = start
    while first > 0 and text[first - 1].isalnum():
        first -= 1
    return first, _URL.match(text, start).end()


#: A run of digits with the signs that group them.
_DIGITS = re.compile(r"(?<![\w.])(?:\+|\()?\d(?:[\d().\-/]| (?=[\d(])){5,}(?!\w)")
_ID_SHAPES = re.compile(r"\d{3}-\d\d-\d{4}|\d{3} \d\d \d{4}|\d\d\.\d\d\.\d{6}|\d{6}-\d{4}|\d{17}[\dXx]")
_ID_LETTERS = re.compile(r"[A-Za-z]{2} ?\d(?<!\w[A-Za-z]{2}\d)(?<!\w[A-Za-z]{2} \d)(?:\d\d \d{3} \d\d ?[A-Za-z]|(?<! \d)\d{4}[A-Za-z0-9]\d)(?!\w)")
#: Accounts and identities with letters, which their check characters must confirm.
_CHECKED = re.compile(
    r"(?=[A-Z\d])(?<!\w)(?:(?P<account>[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)|(?P<dni>\d{8}-?[A-HJ-NP-TV-Z])|(?P<nie>[XYZ]-?\d{7}-?[A-HJ-NP-TV-Z])|(?P<fiscal>[A-Z]{6}\d\d[A-EHLMPRST]\d\d[A-Z]\d{3}[A-Z])"
    r"|(?P<card>[2-6]\d{3}(?:[ \-]?\d{4}){2}[ \-]?\d{2,7})|(?P<cpf>\d{3}\.\d{3}\.\d{3}-\d\d)|(?P<nir>[12] \d\d \d\d \d\d \d{3} \d{3} \d\d)|(?P<resident>\d{17}[\dXx]))(?!\w)"
)
_SOME_DIGITS = re.compile(r"\d\d")  # no number without
_SERIAL = re.compile(r"(?:19|20|21)\d\d-\d{5}")  # a year and a running number
#: Words before a number that is no person's, and units after one.
_NOT_NUMBERS = re.compile(
    r"(?:\b(?:build|order|batch|entry|version|line|page|manual|ticket|invoice|serial|model|port|isbn(?:-1[03])?|issue|commit|row|bestellung|rechnung|commande|facture|pedido|factura|encomenda|fatura|ordine|fattura|поръчка|фактура|заказ|счёт)\s*(?:no\.?|number|nr\.?|n[oº°]\.?|№|#)?:?"
    r"|[$€£¥])\s*$",
    re.I,
)
_UNITS = re.compile(r"\s?(?:bytes?|bits?|[kmgt]i?b|tokens?|rows?|records?|words?|characters?|lines?|pixels?|px|km|cm|mm|kg|mg|ms|seconds?|minutes?|hours?|days?|years?|miles?|percent|euros?|dollars?|usd|eur|gbp)(?!\w)|\s?[%€$£¥°]", re.I)
_DATE = re.compile(r"(?:\d{1,2}[./\-]\d{1,2}[./\-](?:19|20)?\d\d|(?:19|20)\d\d[./\-]\d{1,2}[./\-]\d{1,2})(?: \d{1,2})?")
_NETWORK = re.compile(r"(?:\d{1,3}\.){3}\d{1,3}")


def _valid_date(run: str) -> bool:
    parts = [int(x) for x in re.findall(r"\d+", run)][:3]
    day, month = (parts[2], parts[1]) if parts[0] > 31 else (min(parts[:2]), max(parts[:2])) if max(parts[:2]) <= 12 else (max(parts[:2]), min(parts[:2]))
    return 1 <= day <= 31 and 1 <= month <= 12


def _luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0 and len(set(digits)) > 1


def _book(digits: str) -> bool:
    """A book number by its check digit."""
    return len(digits) == 13 and digits[:3] in ("978", "979") and sum(int(d) * (1, 3)[i % 2] for i, d in enumerate(digits)) % 10 == 0


def _fiscal(code: str) -> bool:
    """The Italian code: letters and digits at odd places count by a fixed table, the others by value."""
    odd = dict(zip("0123456789", (1, 0, 5, 7, 9, 13, 15, 17, 19, 21)))
    odd |= dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", (1, 0, 5, 7, 9, 13, 15, 17, 19, 21, 2, 4, 18, 20, 11, 3, 6, 8, 12, 14, 16, 10, 22, 25, 24, 23)))
    total = sum(odd[c] if i % 2 == 0 else int(c) if c.isdigit() else ord(c) - 65 for i, c in enumerate(code[:15]))
    return chr(65 + total % 26) == code[15]


def _confirmed(m: re.Match) -> bool:
    """Whether check characters confirm an account or identity number."""
    kind, bare = m.lastgroup, re.sub(r"[ .\-]", "", m.group()).upper()
    if kind == "account":
        return 15 <= len(bare) <= 34 and int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
    if kind == "card":
        return 13 <= len(bare) <= 19 and _luhn(bare) and not _book(bare)
    if kind in ("dni", "nie"):
        number = bare[:-1].translate(str.maketrans("XYZ", "012"))
        return "TRWAGMYFPDXBNJZSQVHLCKE"[int(number) % 23] == bare[-1]
    if kind == "fiscal":
        return _fiscal(bare)
    if kind == "cpf":
        checks = [sum(int(d) * w for d, w in zip(bare, range(n + 1, 1, -1))) * 10 % 11 % 10 for n in (9, 10)]
        return checks == [int(bare[9]), int(bare[10])] and len(set(bare)) > 1
    if kind == "nir":
        return 97 - int(bare[:13]) % 97 == int(bare[13:])
    weights = (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2)
    return "10X98765432"[sum(int(d) * w for d, w in zip(bare, weights)) % 11] == bare[17]


_BREAK = re.compile(r"[\n!?。！？؟;；]|\.(?=\s|$)")


class _Sentences:
    """Where the sentences of a text begin; found once, when first asked for."""

    def __init__(self, text: str):
        self.text, self.begins = text, None

    def begin(self, at: int) -> int:
        if self.begins is None:
            # The point of an initial doesn't end a sentence.
            self.begins = [0] + [m.end() for m in _BREAK.finditer(self.text) if m.group() != "." or not re.search(r"(?:^|[\s,])[^\W\d_]$", self.text[max(0, m.start() - 2) : m.start()])]
        return self.begins[bisect_right(self.begins, at) - 1]


_NUMBER = r"\d{1,4}\s?[a-z]?(?![\w])"
_W = r"[^\W\d_][\w'\-]*"
_AFTER, _JOINED, _BEFORE = ("|".join(x) for x in (STREETS_AFTER, STREETS_JOINED, STREETS_BEFORE))
#: A town after the house number; words that don't belong to it are taken off by _trim.
_TOWN = rf"(?:,? (?:in|à|a|em) {_W}(?: {_W}){{0,2}}|, (?:\d{{5}} )?{_W}(?: {_W}){{0,2}}(?: \d{{5}})?)?"
_PATTERNS = [
    re.compile(rf"(?<!\w)\d{{1,4}}\s?[a-z]? (?:{_W} ){{1,3}}(?:{_AFTER})\b(?:,? flat \d+)?{_TOWN}", re.I),
    re.compile(rf"(?<!\w)(?:{_W} ){{1,3}}(?:{_AFTER}),? (?:no\.? ?)?{_NUMBER}(?:,? flat \d+)?{_TOWN}", re.I),
    re.compile(rf"(?<!\w)(?:(?:alte|neue|alter|am|an der|obere|untere) )?[\wäöüß]*(?:{_JOINED})\s+(?:nr\.? ?)?{_NUMBER}{_TOWN}", re.I),
    re.compile(rf"(?<!\w)[Aa][Mm] [A-ZÄÖÜ]{_W} {_NUMBER}{_TOWN}"),
    re.compile(rf"(?<!\w)\d{{1,4}}(?: ?bis| ?ter)?,? (?:{_BEFORE})\s+{_W}(?: {_W}){{0,4}}(?:, \d{{5}} {_W}(?: [A-Z][\w'\-]*)?)?", re.I),
    re.compile(rf"(?<!\w)(?:{_BEFORE})\s+{_W}(?: {_W}){{0,4}},? (?:n\.? ?[oº°]\.? ?)?\d{{1,4}}(?:/[A-Za-z]|\s?[a-z](?!\w))?(?:, \d\.?[oº°]? ?\w+\.?)?(?:, interno \d+)?{_TOWN}", re.I),
    re.compile(r"(?:\d{5},? )?(?:г\. ?[^,\n\d]{2,24}, ?)?(?:ул|бул|пр|пер|просп|пл|наб|ж\.к)\. ?[„«\"“]?[^\W\d_][^\n\d,„“»\"]{1,28}[“»\"]?,? ?(?:№|no|n|д\.|дом|бл\.)? ?\d{1,4}(?:, ?(?:кв|вх|ап)\.? ?\w+)*(?:, ?\d{5})?(?: [А-Я][\w\-]+)*", re.I),
    re.compile(r"(?:г\. ?[^,\n\d]{2,24}, ?)?[^\W\d_][\w\-]+ (?:наб|пер|просп|пр|бул)\.,? ?(?:д\.|дом)? ?\d{1,4}(?:, ?кв\. ?\d+)?", re.I),
    re.compile(r"\d{1,4} (?:شارع|طريق|زقاق|ساحة|حارة) [^\W\d_]+(?: [^\W\d_]+){0,2}|(?:شارع|طريق|زقاق|ساحة|حارة) [^\n\d،,.]{2,30}[،,]? ?(?:عمارة )?\d{1,4}(?:[،,] ?شقة \d+)?(?:[،,] ?[^\W\d_]+(?: [^\W\d_]+)?)?(?: \d{5})?"),
    re.compile(r"(?:[㐀-鿿]{2,4}[市县镇区])?[㐀-鿿]{1,5}(?:路|街|巷|大道|弄) ?\d{1,5} ?号(?:\d+栋)?(?:\d+[室号])?"),
]


#: The patterns that each sort of street word stands in.
_ADDRESS = {"after": _PATTERNS[:2], "joined": _PATTERNS[2:3], "am": _PATTERNS[3:4], "before": _PATTERNS[4:6], "cyrillic": _PATTERNS[6:8], "arabic": _PATTERNS[8:9], "han": _PATTERNS[9:]}


def _addresses(text: str, anchors: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """Streets with a house number around anchors; each line is searched once for each sort of anchor."""
    lines: dict[tuple[int, str], list[int]] = {}
    for at, kind in anchors:
        lines.setdefault((text.rfind("\n", 0, at) + 1, kind), []).append(at)
    out: list[tuple[int, int]] = []
    for (low, kind), places in lines.items():
        high = text.find("\n", low)
        high = high if high >= 0 else len(text)
        for pattern in _ADDRESS[kind]:
            for m in pattern.finditer(text, low, high):
                a, b = m.span()
                # Some anchor must stand in it.
                if any(a <= at + 3 and b >= at for at in places[bisect_right(places, a - 4) : bisect_right(places, b)]) and not any(a < y and x < b for x, y in out):
                    out.append(_trim(text, a, b))
    return out


_BEFORE_STREET = re.compile(
    r"(?:.*?\b(?:to|at|it|in|live|moved|an|en|em|in|au|à|na|para|a|на|по|сюда|إلى|في|je|j'habite|vivo|moro|abito)\s+)(?=\S)|.*(?:住在|搬到了|送到|到了|住)", re.I
)


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    """The span without words before the street and after the town that aren't part of it."""
    head = re.match(r"[^\d,]*", text[a:b]).group()
    words = head.split(" ")
    if any(w[:1].isupper() for w in words):  # otherwise the case tells nothing
        if any("㐀" <= c <= "鿿" for c in head) is False and not head.isupper():
            street = max((i for i, w in enumerate(words) if w[:1].isupper()), default=0)
            i = 0
            while i < street and words[i][:1].islower() and words[i].lower() not in STREETS_BEFORE and words[i].lower() not in STREETS_CYRILLIC:
                a += len(words[i]) + 1
                i += 1
    if m := _BEFORE_STREET.match(head) if "㐀" <= head[:1] <= "鿿" else None:
        a += m.end()
    tail = text[a:b].split(" ")
    while len(tail) > 3 and tail[-1][:1].islower() and any(w[:1].isupper() for w in tail[:-1]) and tail[-1].isalpha() and any(c.isdigit() for w in tail[:-1] for c in w):
        b -= len(tail[-1]) + 1
        tail.pop()
    return a, b


_NAME_WORD = r"(?:[^\W\d_]\.|[^\W\d_][^\W\d_'\-]*(?:['\-][^\W\d_]+)*)"
_NAME = re.compile(rf"{_NAME_WORD}(?:,? {_NAME_WORD}){{0,3}}")
_HAN_NAME = re.compile(r"[㐀-鿿]{2,4}?(?=正在|签名|[，,。.!！；;\s]|$)|[㐀-鿿]{1,2}(?:先生|女士|小姐)")
_NO_NAME = frozenset(
    "id tel cc fax email e-mail phone telefon tel. telephone mail user assistant human system q a usuario the and my call send please batch according to in on at of for "
    "or if is it an as by no so yes nie und der die das ein le la les un une et de du des el los y en con per il lo e di da o os um uma que não и в на не по с что от за".split()
)


def _name_at(text: str, at: int, stop: str) -> tuple[int, int] | None:
    """A name that begins at a place; ``stop`` ends it."""
    while at < len(text) and text[at] in " \t*_\"'«„“”>:\n" and text[at] != "\n":
        at += 1
    if at < len(text) and "㐀" <= text[at] <= "鿿":
        m = _HAN_NAME.match(text, at)
        return (at, m.end()) if m else None
    m = _NAME.match(text, at)
    if not m:
        return None
    words = [w for w in re.finditer(_NAME_WORD, m.group())]
    kept = []
    for w in words:
        if stop and re.match(stop + r"(?!\.)", text[at + w.start() :], re.I):
            break
        if w.group().lower() in _NO_NAME:
            break
        if kept and not stop and kept[0].group()[0].isupper() and w.group()[0].islower():
            break  # a name in capitals has ended
        kept.append(w)
        after = text[at + w.end() : at + w.end() + 1]
        if after == "." and not w.group().endswith("."):
            break
    if not kept or re.match(r"[\-']?\d", text[at + kept[-1].end() : at + kept[-1].end() + 2]):
        return None
    if not stop and len(kept) > 2 and not any("," in text[at + a.end() : at + b.start()] for a, b in zip(kept, kept[1:])):
        kept = kept[:2]
    return at, at + kept[-1].end()


def _name_before(text: str, start: int, floor: int, sentences: _Sentences) -> tuple[int, int] | None:
    """A name that stands before a finding, set off by a bracket, a dot or a comma."""
    at = start
    while at > floor and text[at - 1] in " <":
        at -= 1
    if text[floor:at].endswith("<mailto:"):
        at -= 8
    if at <= floor or text[at - 1] not in "(·,،，":
        return None
    at -= 1
    while at > floor and text[at - 1] == " ":
        at -= 1
    low = max(floor, sentences.begin(at - 1) if at > 0 else 0)
    low = max(low, text.rfind(">", low, at) + 1)
    piece = text[low:at]
    lead = len(piece) - len(piece.lstrip(" \t*_\"'«„“—–-)]）,，;；:：·"))
    piece = piece[lead:]
    if "㐀" <= piece[:1] <= "鿿":
        return (low + lead, at) if 2 <= len(piece) <= 5 else None
    words = piece.replace(",", " ").split()
    if not 1 <= len(words) <= 4 or not all(re.fullmatch(_NAME_WORD, w) for w in words) or any(w.lower() in _NO_NAME for w in words):
        return None
    return low + lead, at


_SIGNED = re.compile(r"(?:^|\n|[.!?。！？؟)\d])\s*$")
_HEADER = re.compile(r" ?([^\n:：]+)[:：]")
_CAPITALS = re.compile(r"(?:[^\W\d_]\. ?)?[^\W\d_][\w'’\-]*(?: (?:(?:van|von|de|da|di|del|della|du|bin|al|el|la)\b ?)*[^\W\d_][\w'’\-]*){0,2}")
_NO_PERSON = frozenset(
    "support service team office department desk center centre bank company inc ltd gmbh sales customer human world everyone everybody all there monday tuesday wednesday thursday friday saturday sunday january february march april "
    "june july august september october november december montag dienstag mittwoch donnerstag freitag samstag sonntag gott god".split()
)


def _capitals(text: str, at: int, least: int) -> tuple[int, int] | None:
    """One to three names in capitals that begin at a place; in scripts without capitals one."""
    m = _CAPITALS.match(text, at)
    if not m:
        return None
    words = re.findall(r"[^\W\d_][\w'’\-]*\.?", m.group())
    kept = []
    for w in words:
        arabic = "\u0600" <= w[0] <= "\u06ff"
        if not (w[0].isupper() and (not w.isupper() or len(w) < 3) or (arabic and not kept) or w.lower() in ("van", "von", "de", "da", "di", "del", "della", "du", "bin", "al", "el", "la")):
            break
        if w.lower().rstrip(".") in _NO_PERSON or w.lower() in _NO_NAME and not kept or any(c.isdigit() for c in w):
            return None
        kept.append(w)
    while kept and kept[-1][0].islower():
        kept.pop()
    if len([w for w in kept if w[0].isupper() or "\u0600" <= w[0] <= "\u06ff"]) < least:
        return None
    end = at
    for w in kept:
        end = text.index(w, end) + len(w)
    return at, end - (text[end - 1] == "." and len(kept[-1]) > 2)


def _begins_word(low: str, start: int, word: str) -> bool:
    return not (start and low[start - 1].isalpha() and word[0].isalpha() and not "㐀" <= word[0] <= "鿿" and not "؀" <= word[0] <= "ۿ")


def _numbers(folded: str, hits: list, sentences: _Sentences, free, taken: list) -> Iterator[tuple[int, int, str]]:
    """Phone and identity numbers among the runs of digits."""
    cues = sorted((end, what) for _, end, what, _ in hits if what in ("phone", "id"))
    ends = [end for end, _ in cues]
    for m in _DIGITS.finditer(folded):
        spans = [(m.start(), m.end())]
        if sum(c.isdigit() for c in m.group()) > 18:  # several numbers in a row
            spans = [(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"[^ /]+", m.group())]
        for a, b in spans:
            run = folded[a:b].rstrip(" .-/(")
            b = a + len(run)
            digits = sum(c.isdigit() for c in run)
            if not 6 <= digits <= 18 or not free(a, b):
                continue
            i = bisect_right(ends, a) - 1
            # A cue holds for the rest of its sentence, one of an identity until it has its number.
            cue = cues[i][1] if i >= 0 and sentences.begin(a) <= ends[i] else None
            if cue == "id" and any(ends[i] <= x < a for x, _, kind in taken if kind == "id_number"):
                cue = None  # it has its number
            plain = re.sub(r"\D", "", run)
            if cue != "phone":
                if _SERIAL.fullmatch(run) or _book(plain) or (_DATE.fullmatch(run) and _valid_date(run)) or (_NETWORK.fullmatch(run) and all(int(x) < 256 for x in run.split("."))):
                    continue
                if _NOT_NUMBERS.search(folded[max(0, a - 24) : a]) or (run.isdigit() and _UNITS.match(folded, b)):
                    continue
            elif _DATE.fullmatch(run) and _valid_date(run):
                continue
            dotted = folded[max(0, a - 3) : a].rstrip().endswith("·")
            if _ID_SHAPES.fullmatch(run) and cue != "phone":
                kind = "id_number"
            elif cue == "id" or dotted:
                kind = "id_number" if digits >= 7 else None
            elif cue == "phone" or run[0] in "+(" or digits >= 9 or re.fullmatch(r"\d{3}-\d{4}|\d{3}-\d\d-\d\d|\d{3} \d{4}", run):
                kind = "phone" if digits <= 15 else "id_number"
            elif digits >= 7 and re.search(r"[/,،，(·]\s*$|(?:^|\n)\s*$", folded[max(0, a - 3) : a]):
                kind = "phone"
            else:
                kind = None
            if kind:
                yield a, b, kind


def _names(folded: str, low: str, hits: list, sentences: _Sentences) -> Iterator[tuple[int, int]]:
    """Names by the words beside them."""
    for start, end, what, word in hits:
        if what in ("name", "off", "send", "title", "contact", "end") and not _begins_word(low, start, word):
            continue
        span = None
        if what == "name":
            span = _name_at(folded, end, NAME_CUES[word])
        elif what == "off":
            at = end
            while at < len(folded) and folded[at] in ", \n\r\t":
                at += 1
            span = _name_at(folded, at, "")
        elif what == "send":
            link, stop = SEND_CUES[word]
            at = end
            if link:
                m = re.compile(rf"[^.!?\n。！？]*?{link}").match(low, end)
                at = m.end() if m else -1
            else:
                while at < len(folded) and folded[at] in " :：,":
                    at += 1
            span = _name_at(folded, at, stop) if at >= 0 else None
            # A single word in small letters is a name only where the sentence goes on as expected.
            if span and " " not in folded[span[0] : span[1]] and folded[span[0]].islower() and not (stop and re.match(rf"\s+(?:{stop})", folded[span[1] :], re.I)):
                span = None
        elif what in ("title", "contact"):
            span = _capitals(folded, end, 1 if what == "title" else 2)
        elif what == "end":
            opener = NAME_ENDS[word]
            begin = sentences.begin(start - 1) if start else 0
            at = low.rfind(opener, begin, start)
            if at >= 0:
                a, b = at + len(opener), start
                while b > a and folded[b - 1] == " ":
                    b -= 1
                piece = folded[a:b]
                words = piece.replace(",", " ").split()
                if "㐀" <= piece[:1] <= "鿿":
                    span = (a, b) if 2 <= len(piece) <= 5 else None
                elif 1 <= len(words) <= 4 and all(re.fullmatch(_NAME_WORD, w) for w in words) and not any(w.lower() in _NO_NAME for w in words):
                    span = (a, b)
        elif what == "sign" and word == ">":
            line = folded.rfind("\n", 0, start) + 1
            if not folded[line:start].strip() or re.search(r"[.!?)。]\s*$", folded[max(line, start - 8) : start]):
                m = _HEADER.match(folded, end)
                words = m.group(1).replace(",", " ").split() if m else []
                if m and (1 <= len(words) <= 4 and all(re.fullmatch(_NAME_WORD, w) for w in words) and not any(w.lower() in _NO_NAME for w in words)):
                    span = m.span(1)
        elif what == "sign" and _SIGNED.search(folded[max(0, start - 4) : start]):
            span = _name_at(folded, end, "")
            if span and not (folded[span[0]].isupper() or "㐀" <= folded[span[0]] <= "鿿" or not folded[span[1] :].split("\n", 1)[0].strip()):
                span = None
        if span:
            yield span


def find(text: str) -> list[tuple[int, int, str]]:
    """The findings of a message: start, end and kind, in order and without overlap."""
    if not text:
        return []
    folded = _fold(text)
    low = _lower(folded)
    hits = [(end + 1 - len(word), end + 1, what, word) for end, found in _A.iter(low) for what, word in found]
    letters = []
    if _SOME_DIGITS.search(folded):
        letters = [(m.start(), m.end(), "id_number") for m in _CHECKED.finditer(folded) if _confirmed(m)]
        letters += [(m.start(), m.end(), "id_number") for m in _ID_LETTERS.finditer(folded)]
    if not hits and not letters and not _DIGITS.search(folded):
        return []
    urls = [_url(folded, start) for start, _, what, _ in hits if what == "url"]
    taken: list[tuple[int, int, str]] = []
    for start, end, what, _ in hits:
        # The user part of a URL is no address, what stands in its query may be.
        if what == "email" and not any(a <= start < b and not ({"/", "?"} & set(folded[folded.index("://", a) + 3 : start])) for a, b in urls):
            if span := _email(folded, start, end):
                taken.append((*span, "email"))
    streets = [(start + word.startswith(" "), what[7:]) for start, _, what, word in hits if what.startswith("street-")]
    taken += [(*span, "address") for span in _addresses(folded, streets)] if streets else []

    def free(a: int, b: int) -> bool:
        return not any(a < y and x < b for x, y, _ in taken)

    for a, b, kind in letters:
        if free(a, b):
            taken.append((a, b, kind))
    sentences = _Sentences(folded)
    cued = [h for h in hits if h[2] not in ("phone", "id") or _begins_word(low, h[0], h[3])]
    outside = lambda a, b: free(a, b) and not any(x <= a < y for x, y in urls)
    for a, b, kind in _numbers(folded, cued, sentences, outside, taken):
        taken.append((a, b, kind))
    names = [(*span, "name") for span in _names(folded, low, hits, sentences)]
    floor = 0
    for a, b, _ in sorted(taken):
        if span := _name_before(folded, a, floor, sentences):
            names.append((*span, "name"))
        floor = b
    for a, b, kind in sorted(names, key=lambda s: (s[0], -s[1])):
        if free(a, b):
            taken.append((a, b, kind))
    out: list[tuple[int, int, str]] = []
    for a, b, kind in sorted(taken, key=lambda s: (s[0], -s[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b, kind))
    return out


def redact(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with placeholders in place of the findings."""
    parts, at = [], 0
    for a, b, kind in found:
        parts += [text[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join((*parts, text[at:]))


def _blocks(content: str) -> list[dict] | None:
    """The block list of a message whose content is one."""
    if content[:1] != "[" and content[:8].lstrip()[:1] != "[":
        return None
    try:
        value = json.loads(content)
    except ValueError:
        return None
    ok = isinstance(value, list) and value and all(isinstance(b, dict) for b in value) and any(isinstance(b.get("type"), str) for b in value)
    return value if ok else None


def find_in_message(content: str | None) -> set[str]:
    """The kinds a message holds."""
    if not content:
        return set()
    blocks = _blocks(content)
    texts = [b["text"] for b in blocks if b.get("type") == "text" and isinstance(b.get("text"), str)] if blocks is not None else [content]
    return {kind for t in texts for _, _, kind in find(t)}


_TEXT_VALUE = re.compile(r'"text"\s*:\s*("(?:[^"\\]|\\.)*")')
_LITERAL = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\.|.", re.S)


def _redact_literal(literal: str) -> str:
    """A JSON string with placeholders in place of the findings of its value; the rest of it unchanged."""
    found = find(json.loads(literal))
    if not found:
        return literal
    # Each character of the value with its place in the literal.
    places = [m.start() + 1 for m in _LITERAL.finditer(literal[1:-1])] + [len(literal) - 1]
    parts, at = [], 0
    for a, b, kind in found:
        parts += [literal[at : places[a]], PLACEHOLDERS[kind]]
        at = places[b]
    return "".join((*parts, literal[at:]))


def redact_message(content: str | None) -> str | None:
    """The message with placeholders; the same object if it holds nothing."""
    if not content:
        return content
    blocks = _blocks(content)
    if blocks is None:
        found = find(content)
        return redact(content, found) if found else content
    values = list(_TEXT_VALUE.finditer(content))
    owners = [b for b in blocks if isinstance(b.get("text"), str)]
    if len(values) != len(owners) or any(json.loads(m[1]) != b["text"] for m, b in zip(values, owners)):
        # Not a plain list of blocks: written anew.
        for b in owners:
            b["text"] = redact(b["text"], find(b["text"])) if b.get("type") == "text" else b["text"]
        return json.dumps(blocks, ensure_ascii=False)
    parts, at = [], 0
    for m, b in zip(values, owners):
        if b.get("type") == "text":
            parts += [content[at : m.start(1)], _redact_literal(m[1])]
            at = m.end(1)
    return "".join((*parts, content[at:])) if parts else content


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, lists = b.column(0), b.column(1)
        contents = lists.values.field("content").to_pylist()
        offsets, names = lists.offsets.to_pylist(), ids.to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        for i, valid in enumerate(lists.is_valid().to_pylist()):
            if not valid or names[i] is None:
                continue
            for turn, content in enumerate(contents[offsets[i] : offsets[i + 1]]):
                for kind in sorted(find_in_message(content)):
                    for column, value in zip(out, (names[i], turn, kind)):
                        column.append(value)
        yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], ["id", "turn", "kind"])


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(1)
        values = lists.values
        contents = pa.array([redact_message(c) for c in values.field("content").to_pylist()], pa.string())
        inner = pa.StructArray.from_arrays([values.field("role"), contents], ["role", "content"])
        offsets = lists.offsets
        if lists.null_count:  # a null list is marked by a null offset
            offsets = pa.array([o if v else None for o, v in zip(offsets.to_pylist(), lists.is_valid().to_pylist())] + [offsets[-1].as_py()], pa.int32())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(offsets, inner)], ["id", "messages"])


def findings(sft: DataFrame) -> DataFrame:
    """id, turn, kind: one row for each kind a message holds."""
    return sft.select("id", "messages").mapInArrow(_found, "id string, turn int, kind string").distinct()


def redacted(sft: DataFrame) -> DataFrame:
    """id and messages of every row, with placeholders."""
    return sft.select("id", "messages").mapInArrow(_redacted, "id string, messages array<struct<role:string,content:string>>")
