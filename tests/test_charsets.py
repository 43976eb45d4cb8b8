"""Charsets told by declarations and by bytes."""

from __future__ import annotations

import codecs

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docweave.functions import automata, charsets, media

# Sentences that no table of the module was made from.
PROSE = {
    "west": ["Le cœur a ses raisons que l'été éphémère ne connaît pas, même à l'automne où les forêts dorées s'endorment.",
             "Über den Dächern der Städte hängen schwere Wolken, während die Straßen schon für das große Fest geschmückt sind.",
             "El niño pequeño soñó que la montaña se convertía en un océano de árboles y él nadaba hacia la mañana."],
    "cyrillic": ["Съешь же ещё этих мягких французских булок да выпей чаю, сказала бабушка внуку вечером.",
                 "Поезд медленно отошёл от станции, и пассажиры молча смотрели на заснеженные поля за окном.",
                 "Новая библиотека открылась в центре города; туда приходят студенты, учителя и пенсионеры."],
    "greek": ["Η θάλασσα ήταν ήρεμη το πρωί και οι ψαράδες γύριζαν αργά προς το λιμάνι με τις βάρκες τους.",
              "Ο δάσκαλος διάβασε στα παιδιά μια ιστορία για τον ήλιο και το φεγγάρι."],
    "hebrew": ["הילדים שיחקו בגינה עד שירד הערב ואז חזרו הביתה לאכול ארוחה חמה עם המשפחה."],
    "japanese": ["昨日の夜は雨が降っていたので、駅から家まで走って帰りました。今朝はよく晴れています。",
                 "この図書館には古い本がたくさんあります。学生たちは毎日ここで静かに勉強しています。"],
    "simplified": ["昨天晚上下了一场大雨，今天早上天气很好，孩子们都去公园里玩了。",
                   "这家图书馆收藏了许多古老的书籍，学生们每天都来这里安静地学习。"],
    "traditional": ["昨天晚上下了一場大雨，今天早上天氣很好，孩子們都去公園裡玩了。",
                    "這家圖書館收藏了許多古老的書籍，學生們每天都來這裡安靜地學習。"],
    "korean": ["어제 밤에는 비가 많이 내렸지만 오늘 아침에는 날씨가 아주 맑아서 아이들이 공원에서 놀고 있다.",
               "이 도서관에는 오래된 책이 많고 학생들은 매일 여기에서 조용히 공부한다."],
}
CASES = [
    ("windows-1252", "west"), ("ISO-8859-15", "west"), ("KOI8-R", "cyrillic"), ("windows-1251", "cyrillic"), ("IBM866", "cyrillic"),
    ("ISO-8859-5", "cyrillic"), ("windows-1253", "greek"), ("windows-1255", "hebrew"), ("Shift_JIS", "japanese"), ("EUC-JP", "japanese"),
    ("GB18030", "simplified"), ("Big5", "traditional"), ("EUC-KR", "korean"),
]


def pieces(script, length):
    return [s[k : k + length] for s in PROSE[script] for k in range(0, max(1, len(s) - length + 1), 7)]


def accuracy(length):
    right = total = 0
    wrong = []
    for charset, script in CASES:
        texts = [t for t in pieces(script, length) if any(ord(c) > 127 for c in t)]
        raw = [t.encode(charsets.CODECS[charset], "replace") for t in texts]
        for t, r, names in zip(texts, raw, charsets.rank_charsets(raw)):
            _, got = charsets.read_bytes(r, names)
            total += 1
            if got == r.decode(charsets.CODECS[charset]):
                right += 1
            else:
                wrong.append((charset, names[:3], t))
    return right / total, wrong


@pytest.mark.parametrize("length, least", [(60, 0.99), (30, 0.97), (15, 0.85)])
def test_held_out_prose(length, least):
    """Share of pieces of unseen prose that are read as written, without any declaration."""
    share, wrong = accuracy(length)
    assert share >= least, (share, wrong[:20])


def naive(table, data, state=0):
    out = []
    for b in data:
        state = int(table[b, state])
        out.append(state)
    return out


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=300), st.sampled_from([m[3] for m in charsets.MULTI]))
def test_states_after(raw, table):
    got = automata.states_after(np.frombuffer(raw, np.uint8), table)
    assert got.tolist() == naive(table, raw)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=40), st.sampled_from(["Shift_JIS", "EUC-JP", "GB18030", "Big5", "EUC-KR"]))
def test_automata_refuse_nothing_valid(raw, charset):
    """What the codec reads the automaton reads too."""
    table = next(m[3] for m in charsets.MULTI if m[0] == charset)
    try:
        raw.decode({"Shift_JIS": "shift_jis", "Big5": "big5", "EUC-KR": "euc_kr"}.get(charset, charsets.CODECS[charset]))
    except UnicodeDecodeError:
        return
    assert naive(table, raw)[-1] == 0


def test_declared_and_named(spark):
    """Declarations of every kind, wrong ones, byte order marks, empty and null contents."""
    ru, ja, fr = "Привет, мир — и снова", "日本語のテキスト", "déjà vu"
    rows = [
        ("koi8", ru.encode("koi8-r", "replace"), "koi8-r", "KOI8-R", ru.replace("—", "?")),
        ("sjis", ja.encode("cp932"), "Shift_JIS", "Shift_JIS", ja),
        ("x-sjis", ja.encode("cp932"), " x-sjis ", "Shift_JIS", ja),
        ("c1", "l’été…".encode("cp1252"), "iso-8859-1", "windows-1252", "l’été…"),
        ("1252", "l’été…".encode("cp1252"), "windows-1252", "windows-1252", "l’été…"),
        ("gb2312", "这是中文㐀".encode("gb18030"), "gb2312", "GB18030", "这是中文㐀"),
        ("wrong", ("été " * 5 + "x").encode(), "utf-16be", "UTF-8", "été " * 5 + "x"),
        ("nonsense", fr.encode(), "x-nothing", "UTF-8", fr),
        ("codec", fr.encode(), "base64", "UTF-8", fr),
        ("bom8", codecs.BOM_UTF8 + fr.encode(), "latin1", "UTF-8", fr),
        ("bom16", codecs.BOM_UTF16_LE + fr.encode("utf-16-le"), None, "UTF-16", fr),
        ("no bom", "plain words".encode("utf-16-le"), None, "UTF-16LE", "plain words"),
        ("no bom, be", "plain words".encode("utf-16-be"), None, "UTF-16BE", "plain words"),
        ("jis", ja.encode("iso2022_jp"), None, "ISO-2022-JP", ja),
        ("escape", b"\x1b$ is no Japanese", None, "UTF-8", "\x1b$ is no Japanese"),
        ("meta", f'<html><meta http-equiv="Content-Type" content="text/html; charset=koi8-r">{ru}'.encode("koi8-r", "replace"), None, "KOI8-R", None),
        ("meta 5", f"<meta charset='windows-1251'><p>{ru}".encode("cp1251"), None, "windows-1251", None),
        ("xml", f'<?xml version="1.0" encoding="Shift_JIS"?><a>{ja}</a>'.encode("cp932"), None, "Shift_JIS", None),
        ("user", f"<meta charset=x-user-defined><p>{fr}".encode("latin-1"), None, "ISO-8859-1", None),
        ("nul", b"a\x00bcdefghijk\xc3\xa9", None, "UTF-8", "a\x00bcdefghijké"),
        ("empty", b"", None, "UTF-8", ""),
        ("null", None, "utf-8", None, None),
        ("junk", bytes(range(128, 256)), None, "ISO-8859-1", None),
    ]
    table = spark.createDataFrame([(r[0], bytearray(r[1]) if r[1] is not None else None, r[2]) for r in rows], "name string, raw binary, label string")
    got = {r.name: r.d for r in table.select("name", media.decoded(F.col("raw"), F.col("label")).alias("d")).collect()}
    for name, raw, label, charset, text in rows:
        if charset is not None and name != "junk":
            assert got[name].charset == charset, (name, got[name])
        if text is not None:
            assert got[name].text == text, (name, got[name])
    assert got["null"].text is None and got["junk"].text is not None
    assert got["wrong"].named == "utf-16be" and got["user"].named == "x-user-defined"
    assert got["meta"].text.endswith("снова") and got["xml"].text.endswith(f"{ja}</a>")


def test_python_only_where_needed(spark):
    """Valid UTF-8 and what Spark reads itself never enter the Python function."""
    table = spark.createDataFrame([(bytearray("é".encode()),)], "raw binary")
    plan = table.select(media.decoded(F.col("raw"))["charset"])._jdf.queryExecution().optimizedPlan().toString()
    assert "read_undeclared(CASE WHEN" in plan
