import hashlib
import random

import pytest

from shelfspark.llm.mojibake import LOST, ONE_BYTE, READ_AS, _read, garbled_documents, restore

HE = "התווית על המדף הראתה 4.70 ש״ח, אבל בקופה חויבתי ₪55.69 על אותו קמח כפרי. לקראת החג מציגה הרשת 56 פריטים, מחציתם ללא הנחה אמיתית."
RU = "На ценнике было 78.95 шек., а на кассе пробили 14.20 шек. за товар. Доставка опоздала на 18 минут, и мороженое растаяло. Жаль, больше не придём."
FR = "La réduction de 30 % a disparu, comme d’habitude, après le deuxième passage de la carte fidélité. Où est le gérant ? Ça dépasse l’entendement."
EN = "The shelf label said £4.42, yet the till charged €25.81 for the “very same” spread – it’s a naïve café trick, I wouldn’t."
PAIRS = [("utf-8", w) for w in ("cp1252", "latin-1", "cp1255", "cp1251", "mac_roman", "cp437", "cp850", "cp866", "koi8_r")] + [("cp1255", "cp1252"), ("cp1255", "latin-1"), ("cp1255", "cp1251"), ("cp1251", "cp1252"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp866", "cp1251"), ("cp1252", "mac_roman"), ("cp1252", "cp437")]


def garble(text, true, wrong):
    return _read(text.encode(true), wrong)


@pytest.mark.parametrize(("true", "wrong"), PAIRS)
def test_round_trip(true, wrong):
    tried = 0
    for text in (HE, RU, FR, EN):
        try:
            bad = garble(text, true, wrong)
        except UnicodeEncodeError:
            continue
        if bad != text:
            tried += 1
            assert restore(bad) == text
            assert restore(f"Clean words first.\n{bad}\nקודם טקסט תקין, ואחריו עוד משפט.") == f"Clean words first.\n{text}\nקודם טקסט תקין, ואחריו עוד משפט."
    assert tried


@pytest.mark.parametrize(("true", "wrong"), [("cp1252", "cp1255"), ("mac_roman", "cp862")])
def test_french_seen_as_hebrew_letters(true, wrong):
    texts = ["La qualité du café était très décevante, le lait déjà périmé à la livraison.", "le café de qualité, déjà payé, a été jeté très tôt", "Le prix affiché était différent de celui payé à la caisse.", "Très bonne qualité.", "qualité", "Le garçon a reçu sa monnaie, là où le goût était âcre."]
    for text in texts:
        bad = garble(text, true, wrong)
        assert restore(bad) == text
        assert restore(f"Clean words first.\n{bad}") == f"Clean words first.\n{text}"
    bad = garble(texts[0], true, wrong)
    assert restore(f"Clean words first.\n{bad}\nקודם טקסט תקין, ואחריו עוד משפט.") == f"Clean words first.\n{texts[0]}\nקודם טקסט תקין, ואחריו עוד משפט."


@pytest.mark.parametrize("text", ["קניתי בFacebook וגם בGoogle", "הודעות בFacebookי ובGoogleי של החנות", "ה-WiFi וה-USB של iPhoneים", "וBanatisi חדש עם Lesizipe", "גרסה Bב ודגם Aא", "50mlל יחידה"])
def test_hebrew_beside_latin_stays(text):
    assert restore(text) is None


OTHERS = ["Zażółć gęślą jaźń, proszę o źródło żółtej książki.", "Καλημέρα κόσμε τι κάνεις σήμερα, όλα καλά;", "Țara mea și științele, în județul Brașov, câți ani.", "今天天气很好，我们去公园散步。", "สวัสดีครับ วันนี้อากาศดี", "お元気ですか。カタカナと漢字。"]


@pytest.mark.parametrize("text", OTHERS)
@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp1251", "cp1255", "cp437", "koi8_r", "mac_roman", "cp850", "cp866", "cp862"])
def test_characters_of_all_scripts_by_their_sequences(text, wrong):
    bad = garble(text, "utf-8", wrong)
    assert restore(bad) == text and restore(text) is None
    assert restore(f"Clean words. {bad} End, naïve.\n{HE}\n{RU}") == f"Clean words. {text} End, naïve.\n{HE}\n{RU}"


def test_russian_words_that_are_sequences_of_one_encoding_stay():
    assert restore("почему день клуба только для членов клуба, только только тем только") is None


@pytest.mark.parametrize("layers", range(1, 7))
def test_garbled_many_times(layers):
    for text in (HE, FR, OTHERS[1]):
        bad = text
        for _ in range(layers):
            bad = garble(bad, "utf-8", "cp1252")
        assert restore(bad) == text


def test_snippets_of_all_one_byte_pairs_come_back():
    random.seed(1)
    tried = found = 0
    for text in (HE, RU, FR, EN):
        words = text.split()
        for true in ONE_BYTE:
            for wrong in READ_AS:
                for length in (3, 6, 12):
                    at = random.randrange(len(words) - length + 1)
                    snippet = " ".join(words[at : at + length])
                    try:
                        bad = garble(snippet, true, wrong)
                    except UnicodeEncodeError:
                        continue
                    if bad != snippet:
                        tried += 1
                        found += restore(bad) == snippet
    assert tried > 200 and found >= 0.8 * tried


def test_twice_garbled():
    for text in (HE, FR, EN):
        assert restore(garble(garble(text, "utf-8", "cp1252"), "utf-8", "cp1252")) == text


@pytest.mark.parametrize("text", [HE, RU, FR, EN, "", None, "plain", "Ñandú & piña colada", "Ärger über Öl für 3 €", "Ø 12 cm, Ã grande", "µg/100 g ½ ©", "ΑΓΟΡΑ 5 €", "6 × 330 ml ± 2 %", "São Ângelo, açaí 2 L", "تخفيض على الحليب", "🛒 🍎", "סטוְדנט חָרוּץ", "וBanatisi חדש", "８２０ hampers", "é", "Сёмга и «Я»", HE * 200])
def test_texts_in_order_stay(text):
    assert restore(text) is None


def test_lost_characters():
    assert restore(garble(HE, "utf-8", "cp1252")[:40] + LOST) == ""


def test_very_long_texts_take_time_in_proportion():
    long = (garble(HE, "utf-8", "cp1252") + " " + FR + "\n") * 500
    assert restore(long) == (HE + " " + FR + "\n") * 500
    mixed = (garble(HE, "cp1255", "cp1252") + "\n" + EN + "\n") * 500
    assert restore(mixed) == (HE + "\n" + EN + "\n") * 500


def test_rows(spark):
    bad = garble(FR, "utf-8", "cp1252")
    rows = [(1, bad), (2, FR), (3, None), (4, ""), (5, bad + LOST), (6, bad * 300), (6, bad * 300), (None, bad)]
    random.seed(1)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, restored_md5 string")
    md5 = hashlib.md5(FR.encode()).hexdigest()
    found = sorted((tuple(r) for r in garbled_documents(df, "doc_id", "text").collect()), key=str)
    long = hashlib.md5((FR * 300).encode()).hexdigest()
    assert found == sorted([(1, md5), (5, ""), (6, long), (6, long), (None, md5)], key=str)
    assert garbled_documents(df.limit(0), "doc_id", "text").collect() == []
