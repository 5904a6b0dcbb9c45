"""Secret scans by dictionary-primed zstandard novelty.

Three fixed patterns find the usual forms (assignments, access ids, long hex
runs).  Beyond them, every token-like string near a sensitive word, or in a
private key block, is a candidate: its marginal compressed size is measured with a zstandard
compressor whose dictionary is the code around it and a list of common
identifiers.  Names that are built from known words or repeat what stands
nearby cost few bytes; a random secret costs as many as any random string of
its length and alphabet and is reported as ``novel``.
"""

from __future__ import annotations

import re
import string as ascii_
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from math import log2
from random import Random
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import col, map_batches, slices
from basketry.llm.license_texts import TEXTS

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18

_SENSITIVE = re.compile(r"(?<![a-z])pwd(?![a-z])|pass(?:word|wd|phrase|code)|secret|token|api[ _-]?key|credential|authorization|bearer|private[ _-]?key|access[ _-]?key|client[ _-]?id|signature|cookie", re.I | re.A)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{12,}")
#: A value set to one of the usual names, with signs that passwords have.
_PASSWORD = re.compile(r"""(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[ _-]?key|credentials?)["']?\s*(?:[:=]|=>|:=)\s*["']?([A-Za-z0-9+/_=.~@!#$%^&*?-]{12,})""", re.I | re.A)
_SIGNS = re.compile(r"[@!#$%^&*?]")
#: A mail address; not what stands between a name, a colon and a host.
_MAIL = re.compile(r"(?<![:\w.+-])[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Strings of digits that are no secrets: dates with or without a time, and
#: network addresses.
_ORDINARY = re.compile(
    r"\d{4}[-./]?\d{2}[-./]?\d{2}(?:[T_.-]?\d{2}(?:[-_.]?\d{2}){0,2}(?:\.\d+)?(?:Z|[+-]\d{2,4})?)?"
    r"|\d{1,2}[-./]\d{1,2}[-./]\d{4}(?:[T_.-]\d{2}(?:[-_.]?\d{2}){0,2})?"
    r"|(?:\d{1,3}\.){3}\d{1,3}"
)
#: A key block is context up to its END line, or to the end of the text.
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----.*?(?:-----END|\Z)", re.S)
#: Parts of a candidate: behind an equals sign, and without any sign inside.
_PARTS = (re.compile(r"[^=]{12,}=*"), re.compile(r"[A-Za-z0-9+]{12,}=*"))
_LETTERS = re.compile(r"[a-z]+")
#: Characters before and after a sensitive word, line breaks included, that are
#: its context; a candidate counts if any of it lies there.
REACH = 80
#: Characters of surrounding text on either side that prime the compressor.
AROUND = 2048
#: Reported from this share of what a random string of its length and alphabet costs.
NOVELTY = 0.85
#: Alphabets of candidates, smallest first; the last holds every one.
ALPHABETS = (
    ascii_.digits,
    ascii_.digits + "abcdef",
    ascii_.digits + "ABCDEF",
    ascii_.ascii_lowercase,
    ascii_.ascii_uppercase,
    ascii_.ascii_uppercase + "234567=",
    ascii_.digits + ascii_.ascii_lowercase,
    ascii_.digits + ascii_.ascii_uppercase,
    ascii_.ascii_letters,
    ascii_.digits + ascii_.ascii_letters,
    ascii_.digits + ascii_.ascii_letters + "+/=",
    ascii_.digits + ascii_.ascii_letters + "-_=",
    ascii_.digits + ascii_.ascii_letters + "+/_=.~-",
    ascii_.digits + ascii_.ascii_letters + "+/_=.~-@!#$%^&*?",
)
#: From this length on, a random string costs the same per character.
SETTLED = 8192

#: Identifier words of ordinary code and configuration.
IDENTIFIERS = (
    "username password passphrase credential secret client_secret client_id access_token refresh_token id_token auth_token bearer "
    "authorization authentication authenticate api_key apikey private_key public_key access_key signing_key encryption certificate "
    "session cookie signature header content-type application/json application/x-www-form-urlencoded text/html charset utf-8 "
    "localhost 127.0.0.1 http:// https:// .example.com .org .net www. index.html config configuration settings environment "
    "development production staging default undefined null true false none required optional placeholder changeme your_token_here "
    "your-api-key-here xxxxxxxxxxxxxxxx 0000000000000000 1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ "
    "getParameter setAttribute getElementById addEventListener createElement toString valueOf indexOf length return function "
    "import export from class public static void string integer boolean object request response handler service controller manager "
    "factory provider interface implementation exception error message status result value key name type data file path "
    "directory database connection timeout version number user_id created_at updated_at description"
).encode()


#: Running text of German, French and Spanish, for their letter pairs.
LANGUAGES = """
die gesellschaft der freunde hat beschlossen dass alle mitglieder in der naechsten versammlung ueber die verwendung der einnahmen abstimmen
sollen weil zwischen den verschiedenen abteilungen noch immer keine einigung erreicht worden ist und der vorstand deshalb nicht handeln kann
die geschwindigkeit der schiffe auf der donau wurde wegen des hochwassers beschraenkt sodass die fahrt von einer hauptstadt zur anderen fast
doppelt so lange dauerte wie gewoehnlich trotzdem blieben die meisten reisenden geduldig und warteten auf die ankunft ihrer angehoerigen
rechtschreibung krankenversicherung bundesregierung wissenschaftlich moeglichkeit zusammenarbeit entwicklung berechtigung kennwort schluessel
les habitants de la ville ont demande au conseil municipal de renoncer aux travaux qui devaient commencer pendant le mois de septembre parce
que les rues etroites ne permettent pas le passage des camions et que le bruit serait insupportable pour ceux qui travaillent chez eux
malheureusement le directeur a repondu que le financement avait deja ete obtenu et que les entreprises choisies attendaient seulement une
autorisation definitive il faudrait donc trouver une solution raisonnable avant la fin de la semaine sinon tout serait perdu
gouvernement developpement responsabilite connaissance immediatement quelquefois environnement utilisateur mot de passe cle secrete
los vecinos del pueblo se reunieron en la plaza para escuchar las explicaciones del alcalde sobre la construccion de la carretera nueva que
unira las dos orillas del rio y permitira que los agricultores lleven sus productos al mercado sin tener que rodear las montanas muchos de
ellos preguntaron cuanto tiempo durarian las obras y quien pagaria los gastos pero nadie supo contestar con seguridad porque el presupuesto
todavia no habia sido aprobado por la administracion desarrollo conocimiento responsabilidad inmediatamente ciudadanos trabajadores
universidad investigacion electricidad informacion contrasena usuario clave privada autenticacion
"""


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    #: Where the secret itself begins; for an assignment, behind the sign.
    secret: int
    #: Compressed size as a share of a random string's; None for the fixed patterns.
    novelty: float | None


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and non-overlapping per kind;
    offsets are code points, the end exclusive."""
    found = [Span("assign", m.start(), m.end(), m.start(2), None) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [Span("access", *m.span(), m.start(), None) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [Span("hex", *m.span(), m.start(), None) for m in _HEX.finditer(text)]
    return found


def _without(text: str, string: str, start: int, end: int) -> str:
    """text[start:end] without the copies of ``string``, those cut by its
    edges included; the candidate itself lies outside."""
    parts, at, stop = [], start, min(len(text), end + len(string) - 1)
    found = text.find(string, max(0, start - len(string) + 1), stop)
    while found >= 0:
        parts.append(text[at : max(at, found)])
        at = found + len(string)
        found = text.find(string, at, stop)
    return "\n".join([*parts, text[at:end]])


def _marginal(string: str, primer: bytes) -> int:
    """Compressed bytes that ``string`` adds behind ``primer``."""
    primed = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    squeeze = zstandard.ZstdCompressor(level=6, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False)
    return len(squeeze.compress(string.encode())) - len(squeeze.compress(b""))


@lru_cache(maxsize=4096)
def _random_cost(alphabet: str, length: int) -> float:
    """Marginal bytes per character of a random string."""
    return _marginal("".join(Random(length).choices(alphabet, k=length)), IDENTIFIERS) / length


def novelty(text: str, start: int, end: int, identifiers: bytes = IDENTIFIERS) -> float:
    """Marginal compressed size of text[start:end], given the identifiers and
    the text around it without other copies of the string, as a share of what
    a random string of its length and alphabet costs: 1 if it is as random.
    Short strings are stored byte by byte, whatever their alphabet; longer
    ones are coded by the letters' frequencies."""
    string = text[start:end]
    around = _without(text, string, max(0, start - AROUND), start) + "\n" + _without(text, string, end, min(len(text), end + AROUND))
    alphabet = next(a for a in ALPHABETS if not string.strip(a))
    return _marginal(string, identifiers + b"\n" + around.encode()) / len(string) / _random_cost(alphabet, min(len(string), SETTLED))


def _pairs(text: str) -> Counter[str]:
    low = text.lower()
    return Counter(map("".join, zip(low, low[1:])))


_KNOWN = _pairs("\n".join([IDENTIFIERS.decode(), *dict(TEXTS).values()]))
_OTHERS = _pairs(LANGUAGES)


def reads(string: str, more: str = "") -> bool:
    """Whether the letters of a string follow each other as in words: its
    pairs take fewer bits under the pairs of English, identifiers and ``more``,
    or of German, French and Spanish, than those of random letters.  The compressor stores a word that it has
    not seen like a random string, so strings without digits need this too."""
    pairs = [a + b for run in _LETTERS.findall(string.lower()) for a, b in zip(run, run[1:])]
    if not pairs:
        return False
    for known in (_KNOWN + _pairs(more) if more else _KNOWN, _OTHERS):
        first = {a: sum(known[a + b] for b in ascii_.ascii_lowercase) for a in {p[0] for p in pairs}}
        if -sum(log2((known[p] + 0.5) / (first[p[0]] + 13)) for p in pairs) / len(pairs) < log2(26):
            return True
    return False


def _contexts(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """The sensitive words, and the merged stretches of text that are context."""
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    merged: list[tuple[int, int]] = []
    for start, end in sorted([(max(0, a - REACH), b + REACH) for a, b in words] + [m.span() for m in _KEY_BLOCK.finditer(text)]):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return words, merged


def _holder(spans_: Iterable[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether one of ``spans_`` holds a stretch."""
    ordered = sorted(spans_)
    starts, ends = [a for a, _ in ordered], list(accumulate((b for _, b in ordered), max))

    def holds(start: int, end: int) -> bool:
        i = bisect_right(starts, start) - 1
        return i >= 0 and ends[i] >= end

    return holds


def _forms(text: str, start: int, end: int, words: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What may be the secret in a run of characters: all behind the first
    sensitive word inside, what lies between words, their parts, the run."""
    inside = [(a, b) for a, b in words if a < end and b > start]
    if inside:
        yield inside[0][1], end
    edges = [start, *(x for span in inside for x in span), end]
    between = list(zip(edges[::2], edges[1::2]))
    yield from between
    for part in _PARTS:
        for a, b in between:
            yield from (m.span() for m in part.finditer(text, a, max(a, b)))
    yield start, end


def novel_spans(text: str, known: list[Span], least: float = NOVELTY) -> list[Span]:
    """Incompressible strings in a sensitive context that no span of ``known``
    covers.  One that is novel at one place is reported wherever it stands in
    such a context."""
    words, contexts = _contexts(text)
    if not contexts:
        return []
    word_starts = [a for a, _ in words]
    context_starts = [a for a, _ in contexts]
    covered = _holder((s.start, s.end) for s in known)
    mailed = _holder(m.span() for m in _MAIL.finditer(text)) if "@" in text else lambda start, end: False

    def in_context(start: int, end: int) -> bool:
        i = bisect_left(context_starts, end) - 1
        return i >= 0 and contexts[i][1] > start

    measured: dict[str, float] = {}
    found: dict[tuple[int, int], float] = {}
    cheap: list[tuple[int, int]] = []

    def novel(start: int, end: int) -> bool:
        string = text[start:end]
        if string not in measured:
            if _ORDINARY.fullmatch(string):
                return False
            plain = not any(c.isdigit() for c in string)
            if plain and reads(string):
                return False
            n = novelty(text, start, end)
            if n < least or plain and reads(string, text[max(0, start - AROUND) : end + AROUND].replace(string, "\n")):
                return False
            measured[string] = n
        found[start, end] = measured[string]
        return True

    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        if not in_context(start, end) or mailed(start, end):
            continue
        near = words[max(0, bisect_left(word_starts, start) - 1) : bisect_left(word_starts, end)]
        taken: list[tuple[int, int]] = []
        tried = set()
        for form in _forms(text, start, end, near):
            if form in tried or form[1] - form[0] < 12 or any(form[0] < b and a < form[1] for a, b in taken):
                continue
            tried.add(form)
            if covered(*form):
                taken.append(form)
            elif novel(*form):
                taken.append(form)
            else:
                cheap.append(form)
    # values with other signs, whole where the run of characters ends at a sign
    within = _holder(found)
    for m in _PASSWORD.finditer(text):
        if _SIGNS.search(m[1]) and not covered(*m.span(1)) and not within(*m.span(1)):
            novel(*m.span(1))
    # copies that were cheap beside the one found, alone or inside a longer run
    for start, end in cheap:
        if (n := measured.get(text[start:end])) is not None:
            found[start, end] = n
    for (start, end), n in list(found.items()):
        string, stop = text[start:end], end + AROUND + end - start
        at = text.find(string, max(0, start - AROUND - len(string)), stop)
        while at >= 0:
            if in_context(at, at + len(string)) and not covered(at, at + len(string)):
                found.setdefault((at, at + len(string)), n)
            at = text.find(string, at + len(string), stop)
    spans_, reached = [], 0
    for start, end in sorted(found, key=lambda x: (x[0], -x[1])):
        if end > reached:
            spans_.append(Span("novel", start, end, start, found[start, end]))
            reached = end
    return spans_


def spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind."""
    base = base_spans(text)
    return sorted(base + novel_spans(text, base), key=lambda s: (s.start, KINDS.index(s.kind)))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.int64()), ("novelty", pa.float64())])
SPANS_TYPE = "array<struct<kind:string,start:long,end:long,secret:long,novelty:double>>"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans array), one row per row of ``docs``.  Null text counts as
    empty and has no spans; repeated rows are scanned alike; an empty table
    gives no rows; other columns of ``docs`` are not read."""
    slim = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            found = [[s._asdict() for s in spans(t or "")] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(_SPAN))], ["k", "spans"])

    return map_batches(slim, run, f"k {docs.schema[key].dataType.simpleString()}, spans {SPANS_TYPE}").withColumnRenamed("k", key)


def span_list(spans_: Column) -> Column:
    """"kind:start:end" of the spans, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _mask(text: str, put: str) -> str:
    out, at = [], 0
    for s in sorted(spans(text), key=lambda s: (s.secret, -s.end)):
        if s.end <= at:
            continue
        if s.secret >= at:
            out += [text[at : s.secret], put]
        at = s.end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text", put: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``put``; all rows and
    columns stay, null text stays null."""
    columns = docs.columns
    inner = docs.select(F.struct(*[col(c) for c in columns if c != text]).alias("row"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            masked = [None if t is None else _mask(t, put) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(masked, pa.string())], ["row", "t"])

    done = map_batches(inner, run, inner.schema)
    return done.select(*[F.col("t").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns])
