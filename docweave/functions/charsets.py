"""Charsets of undeclared text: validity automata and byte-pair scores."""

from __future__ import annotations

import codecs
import re
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from docweave.functions.automata import automaton, states_after

# Names of charsets and of the codecs that read them.
CODECS = {
    "UTF-8": "utf-8", "UTF-16": "utf-16", "UTF-16LE": "utf-16-le", "UTF-16BE": "utf-16-be", "UTF-32": "utf-32",
    "US-ASCII": "ascii", "ISO-8859-1": "latin-1", "windows-1252": "cp1252", "ISO-8859-15": "iso8859-15",
    "ISO-8859-2": "iso8859-2", "windows-1250": "cp1250", "ISO-8859-5": "iso8859-5", "windows-1251": "cp1251",
    "KOI8-R": "koi8-r", "KOI8-U": "koi8-u", "IBM866": "cp866", "ISO-8859-7": "iso8859-7", "windows-1253": "cp1253",
    "ISO-8859-8": "iso8859-8", "windows-1255": "cp1255", "ISO-8859-6": "iso8859-6", "windows-1256": "cp1256",
    "ISO-8859-9": "iso8859-9", "windows-1254": "cp1254", "windows-1257": "cp1257", "macintosh": "mac-roman", "Shift_JIS": "cp932", "EUC-JP": "euc_jp",
    "ISO-2022-JP": "iso2022_jp", "GB18030": "gb18030", "Big5": "big5hkscs", "EUC-KR": "cp949",
}
# Names that stand for a wider charset, and names that Python does not know.
WIDER = {"gb2312": "GB18030", "gbk": "GB18030", "shift_jis": "Shift_JIS", "euc_kr": "EUC-KR", "big5": "Big5", "cp65001": "UTF-8"}
ALIASES = {"x-sjis": "Shift_JIS", "windows-31j": "Shift_JIS", "x-euc-jp": "EUC-JP", "ks_c_5601-1987": "EUC-KR", "x-gbk": "GB18030", "x-mac-roman": "macintosh", "unicode": "UTF-16"}

# Letters of the scripts, the most frequent first (counts of ordinary prose).
LETTERS = {
    "west": "éèàêçäüöóíáñßâîôûùëïúãõåøæœ",
    "central": "áíéěčžšřýłąęůćśżóńźúťďňőűäöüăâîşţđ",
    "cyrillic": "оеаинтсрвлкмдпуяыьгзбчйхжшюцщэфъёіїєґ",
    "greek": "αοιετσνηυρπκμλςωίάόέδήγχθύφβώξζψϊϋΐΰ",
    "hebrew": "יוהלאמרתבשנםעדקחפגכטזסןצךףץ",
    "arabic": "اليمنوترهبعسفدكقحةجصشىخطضذزغثظءئأإآؤ",
    "japanese": "のいしるとなはにたをてがでかすらっこれりもさまくあけうそきよえせおわどつみちんめ、。日一国人年大十二本中長出三時行見月分後前生五間上東四今金九入学高円子外八六下来気小七山話女北午百書先名川千水半男西電校語土木聞食車何南万",
    "simplified": "，。的一是不了在人有我他这个们中来上大为和国地到以说时要就出会可也你对生能而子那得于着下自之年过发后作里用道行所然家种事成方多经么去法学如都同现当没动面起看定天分还进好小部其些主样理心她本前开但因只从想实",
    "traditional": "，。的一是不了在人有我他這個們中來上大為和國地到以說時要就出會可也你對生能而子那得於著下自之年過發後作裡用道行所然家種事成方多經麼去法學如都同現當沒動面起看定天分還進好小部其些主樣理心她本前開但因只從想實",
    "korean": "이다는에의가을로하고지한은도들사자기리를시서인해대어나있과일그수아정것라보주제와부으여장거전게구스",
}
# Punctuation that ordinary text of any language has.
MARKS = "’‘“”–—…«»„‚€°§©·№¿¡•"

# Charset, script and how much (in nats) one starts behind.
SINGLE = [
    ("windows-1252", "west", 0.0), ("ISO-8859-15", "west", 1.0), ("windows-1251", "cyrillic", 0.5), ("KOI8-R", "cyrillic", 0.5),
    ("windows-1250", "central", 4.0), ("ISO-8859-2", "central", 4.5), ("ISO-8859-5", "cyrillic", 2.0), ("IBM866", "cyrillic", 2.0),
    ("windows-1253", "greek", 1.0), ("ISO-8859-7", "greek", 1.5), ("windows-1255", "hebrew", 1.0), ("windows-1256", "arabic", 1.0),
    ("ISO-8859-6", "arabic", 1.5), ("macintosh", "west", 12.0),
]
MULTI = [
    ("Shift_JIS", "japanese", 1.0, automaton(3, [(0, "00-80 A0-DF", 0), (0, "81-9F E0-FC", 1), (1, "40-7E 80-FC", 0)], 2)),
    ("EUC-JP", "japanese", 1.0, automaton(5, [(0, "00-80", 0), (0, "A1-FE", 1), (0, "8E", 2), (0, "8F", 3), (1, "A1-FE", 0), (2, "A1-DF", 0), (3, "A1-FE", 1)], 4)),
    (
        "GB18030",
        "simplified",
        1.0,
        automaton(5, [(0, "00-80", 0), (0, "81-FE", 1), (1, "40-7E 80-FE", 0), (1, "30-39", 2), (2, "81-FE", 3), (3, "30-39", 0)], 4),
    ),
    ("Big5", "traditional", 2.0, automaton(3, [(0, "00-80", 0), (0, "81-FE", 1), (1, "40-7E A1-FE", 0)], 2)),
    ("EUC-KR", "korean", 2.0, automaton(3, [(0, "00-80", 0), (0, "81-FE", 1), (1, "41-5A 61-7A 81-FE", 0)], 2)),
]

# Kinds of characters and the logarithm of how likely one follows another.
SPACE, SMALL, CAPITAL, DIGIT, LOWER, UPPER, MARK, SIGN, NONE = range(9)
_C1 = re.compile(rb"[\x80-\x9f]")
# Bytes scored at once.
SLICE = 1 << 22


def _follows(latin: bool) -> np.ndarray:
    """``[kind, next kind]``: letters keep to their script, capitals to their beginning or to each other, signs stand apart."""
    alien = 0 if latin else -5
    rows = {
        SPACE: [0, 0, 0, 0, -0.3, -0.7, -0.7, -1.5, -15],
        SMALL: [0, 0, 0, 0, alien, -4 + alien, -0.7, -4, -15],
        CAPITAL: [0, 0, 0, 0, alien - 0.3, alien - 0.7, -0.7, -4, -15],
        DIGIT: [0, 0, 0, 0, -3, -3, -0.7, -1.5, -15],
        LOWER: [-0.3, alien, alien - 4, -3, 0, -5, -0.7, -4, -15],
        UPPER: [-0.3, alien - 0.3, alien - 0.3, -3, -0.3, -1.2, -0.7, -4, -15],
        MARK: [-0.3, -0.7, -0.7, -0.7, -0.7, -1.5, -1.5, -3, -15],
        SIGN: [-1, -4, -4, -1.5, -4, -4, -3, -2, -15],
        NONE: [-15] * 9,
    }
    return np.array([rows[k] for k in range(9)], np.float32)


def _emission(script: str) -> dict[str, float]:
    """Log probabilities of the listed characters among those beyond ASCII."""
    listed = LETTERS[script]
    weights = 1 / (np.arange(len(listed)) + 4)
    out = {c: float(np.log(0.85 * w / weights.sum())) for c, w in zip(listed, weights)}
    for c, p in list(out.items()):
        if c.upper() != c and len(c.upper()) == 1:
            out.setdefault(c.upper(), p - 2.5)
    for c in MARKS:
        out.setdefault(c, float(np.log(0.08 / len(MARKS))))
    return out


@cache
def pair_scores(charset: str, script: str) -> np.ndarray:
    """(65536,) log probability of each second byte after each first one; 0 where both are ASCII."""
    emission, kind, emit = _emission(script), np.full(256, SPACE), np.zeros(256, np.float32)
    for b in range(256):
        try:
            c = bytes([b]).decode(CODECS[charset])
        except UnicodeDecodeError:
            kind[b], emit[b] = NONE, -15
            continue
        if b < 128:
            kind[b] = SMALL if c.islower() else CAPITAL if c.isupper() else DIGIT if c.isdigit() else NONE if b < 32 and c not in "\t\n\r\f\x1b" else SPACE
        else:
            emit[b] = emission.get(c, -9.0)
            if c in MARKS or c == "\xa0":
                kind[b] = MARK
            elif c.isalpha() or "֑" <= c <= "ٕ":
                kind[b] = UPPER if c.isupper() else LOWER
            else:
                kind[b] = NONE if ord(c) < 0xA0 else SIGN
    table = _follows(script in ("west", "central"))[kind[:, None], kind[None, :]] + emit[None, :]
    table[:128, :128] = 0
    return table.astype(np.float32).ravel()


@cache
def double_scores(charset: str, script: str) -> np.ndarray:
    """(65536,) log probability of each two-byte character."""
    emission = _emission(script)
    table = np.full(65536, -15, np.float32)
    for lead in range(0x81, 0xFF):
        for trail in range(0x40, 0xFF):
            try:
                c = bytes([lead, trail]).decode(CODECS[charset])
            except UnicodeDecodeError:
                continue
            common = script != "korean" and "一" <= c <= "鿿" and _ordinary(charset, lead)
            kana = script == "japanese" and "ぁ" <= c <= "ヾ"
            hangul = script == "korean" and "가" <= c <= "힣" and lead >= 0xB0 and trail >= 0xA1
            mark = "　" <= c <= "〟" or "！" <= c <= "～"
            usual = -6.5 if kana else -9.0 if common or hangul else -8.0 if mark else -13.0
            table[lead << 8 | trail] = emission.get(c, usual) if len(c) == 1 else -15
    return table


def _ordinary(charset: str, lead: int) -> bool:
    """Whether a first byte is one of the common level of its charset."""
    low, high = {"Shift_JIS": (0x88, 0x97), "EUC-JP": (0xB0, 0xCF), "GB18030": (0xB0, 0xD7), "Big5": (0xA4, 0xC6)}.get(charset, (1, 0))
    return low <= lead <= high


def canonical(name: str | None) -> str | None:
    """The name used here of a charset label, null if nothing here reads it."""
    if not name:
        return None
    label = name.strip().strip("\"'").lower()
    if label in ALIASES:
        return ALIASES[label]
    try:
        codec = codecs.lookup(label).name
    except (LookupError, ValueError):
        return None
    if codec in WIDER:
        return WIDER[codec]
    return next((k for k, v in CODECS.items() if codecs.lookup(v).name == codec), None)


def rank_charsets(texts: list[bytes]) -> list[list[str]]:
    """Charsets of each byte text, the likeliest first; ISO-8859-1, which reads anything, is the last.

    All texts are scored together: one look-up for each pair of bytes of which
    one lies beyond ASCII, per single-byte charset; for the others an automaton
    finds invalid texts and the places of their characters.
    """
    # Two blanks after each text: one may end a broken character, the other begins anew.
    flat = np.frombuffer(b" " + b"".join(t + b"  " for t in texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes + 2) - sizes - 1
    text_of = np.repeat(np.arange(len(texts)), sizes + 2)  # of each pair, by its first byte
    high = flat >= 128
    at = np.flatnonzero(high[:-1] | high[1:])
    pairs = flat[at].astype(np.int64) << 8 | flat[at + 1]
    owner = text_of[at]
    names = [s[0] for s in SINGLE] + [m[0] for m in MULTI]
    scores = np.full((len(names), len(texts)), -np.inf)
    for k, (name, script, behind) in enumerate(SINGLE):
        scores[k] = np.bincount(owner, pair_scores(name, script)[pairs], len(texts)) - behind
    for k, (name, script, behind, table) in enumerate(MULTI, start=len(SINGLE)):
        error = table.shape[1] - 1
        guarded = table.copy()
        guarded[0x20, error] = 0
        after = states_after(flat, guarded)
        before = np.concatenate(([0], after[:-1]))
        bad = np.bincount(text_of, after[1:] == error, len(texts)) > 0
        lead = np.flatnonzero((before == 0) & high)
        code = flat[lead].astype(np.int64) << 8 | flat[np.minimum(lead + 1, len(flat) - 1)]
        emit = np.where(after[lead] == 0, -9.0, double_scores(name, script)[code])
        total = np.bincount(text_of[np.maximum(lead - 1, 0)], emit, len(texts)) - behind
        scores[k] = np.where(bad, -np.inf, total)
    out = []
    c1 = np.bincount(text_of, (flat[1:] >= 0x80) & (flat[1:] < 0xA0), len(texts)) > 0
    for i in range(len(texts)):
        order = [names[k] for k in np.argsort(-scores[:, i], kind="stable") if np.isfinite(scores[k, i])]
        order = ["ISO-8859-1" if n == "windows-1252" and not c1[i] else n for n in order]
        order.insert(0, "UTF-8")
        part = flat[starts[i] : starts[i] + sizes[i]]
        zero = [int((part[p::2] == 0).sum()) for p in (0, 1)]
        if len(part) > 1 and max(zero) * 5 > len(part) and max(zero) > 4 * min(zero):
            order.insert(0, "UTF-16BE" if zero[0] > zero[1] else "UTF-16LE")
        out.append([*order, "ISO-8859-1"])
    return out


def read_bytes(raw: bytes, names: list[str]) -> tuple[str, str]:
    """The first charset that reads ``raw`` without error, and the text."""
    for name in names:
        try:
            return name, raw.decode(CODECS[name])
        except UnicodeDecodeError:
            continue
    return "ISO-8859-1", raw.decode("latin-1")


_FOUND = T.StructType([T.StructField("charset", T.StringType()), T.StructField("text", T.StringType())])


@F.pandas_udf(_FOUND)
def read_undeclared(content: pd.Series, named: pd.Series) -> pd.DataFrame:
    """Charset and text of contents that are not null: the named charset if it can read them, else the likeliest."""
    found: list[tuple] = [(None, None)] * len(content)
    open_, volume = [], 0

    def settle():
        for i, names in zip(open_, rank_charsets([bytes(content.iat[i]) for i in open_])):
            found[i] = read_bytes(bytes(content.iat[i]), names)
        open_.clear()

    for i, (raw, label) in enumerate(zip(content, named)):
        if raw is None:
            continue
        raw = bytes(raw)
        name = canonical(label)
        if name == "ISO-8859-1" and _C1.search(raw):
            name = "windows-1252"  # what that name stands for where such bytes occur
        elif name is None and b"\x1b$" in raw:
            name = "ISO-2022-JP"
        if name is not None:
            try:
                found[i] = (name, raw.decode(CODECS[name]))
                continue
            except UnicodeDecodeError:
                pass
        open_.append(i)
        volume += len(raw)
        if volume > SLICE:
            settle()
            volume = 0
    if open_:
        settle()
    return pd.DataFrame(found, columns=["charset", "text"], dtype=object)


# Byte order marks in hex and their charsets, longer ones first.
ORDER_MARKS = [("FFFE0000", "UTF-32"), ("0000FEFF", "UTF-32"), ("EFBBBF", "UTF-8"), ("FFFE", "UTF-16"), ("FEFF", "UTF-16")]
# Where a document names its own charset.
NAMED_WITHIN = 8192


def order_mark(content: Column) -> Column:
    """The charset that a byte order mark tells."""
    head = F.hex(F.substring(content, 1, 4))
    mark = F.lit(None).cast("string")
    for prefix, name in reversed(ORDER_MARKS):
        mark = F.when(F.startswith(head, F.lit(prefix)), F.lit(name)).otherwise(mark)
    return mark


def named_charset(content: Column) -> Column:
    """The charset that a document names in its XML declaration or a ``meta`` element."""
    begin = F.decode(F.substring(content, 1, NAMED_WITHIN), "ISO-8859-1")
    xml = F.regexp_extract(begin, r"^\s*<\?xml[^>]{0,200}?encoding\s*=\s*[\"']([A-Za-z0-9._:-]+)[\"']", 1)
    meta = F.regexp_extract(begin, r"(?is)<meta\b[^>]{0,500}?\bcharset\s*=\s*[\"']?\s*([A-Za-z0-9._:-]+)", 1)
    return F.coalesce(F.nullif(xml, F.lit("")), F.nullif(meta, F.lit("")))
