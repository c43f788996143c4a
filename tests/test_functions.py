"""Text functions on sentences with known results."""

from __future__ import annotations

import random
import re
import time
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import domains, entities, hashing, intents, language, pages, preprocess, questions, romanized, scoring, translate
from corpusloom.functions.textkit import ascii_tokens, spans, whole, words


@pytest.fixture(scope="module")
def on(spark):
    def run(texts, f):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
        return [r["r"] for r in df.select("i", f(F.col("text")).alias("r")).orderBy("i").collect()]

    return run


def test_language(on):
    texts = ["ඩෙංගු " + "වෛද්‍ය" + " මධ්‍ය" + "ස්ථානය", "டெங்கு" " கிளினிக்", "Where is the dengue clinic?", "ඩෙංගු clinic එක කොහෙද", "", "ab", "12345 67890", "... !!! ???", None]
    got = on(texts, language.detect)
    assert [g["language"] for g in got] == ["sinhala", "tamil", "english", "sinhala", "unknown", "unknown", "unknown", "unknown", "unknown"]
    assert [g["script_type"] for g in got] == ["sinhala_script", "tamil_script", "latin", "mixed", "unknown", "unknown", "unknown", "unknown", "unknown"]
    assert round(got[0]["confidence"], 4) == 0.9091 and got[1]["confidence"] == 1.0 and round(got[3]["confidence"], 4) == 0.6667
    assert got[3]["is_mixed_script"] and got[3]["dominant_script"] == "sinhala" and got[7]["shares"] is None
    assert on(["ඩෙ a b"], lambda t: language.extract_script(t, "latin")) == ["a b"]
    assert on(["ඩ x", "x", None], language.is_native) == [True, False, False]
    assert on(["டெ", "x"], lambda t: language.contains_script(t, "tamil")) == [True, False]


ROMANIZED = [
    ("mage amma dengue clinic eka koheda", "singlish", 1.0, (1, 0, 0)), ("mama hospital eke doctor ganna yanna one", "singlish", 0.9, (0.6, 0, 0.4)),
    ("hospital time eka mokakda aney", "singlish", 1.0, (0.75, 0, 0.25)), ("dengue clinic enga irukku hospital la", "tamilish", 0.9667, (0, 0.6667, 0.3333)),
    ("naan hospital ponga theriyuma", "tamilish", 1.0, (0, 1, 0)), ("Where is the dengue clinic located?", "pure_english", 1.0, (0, 0, 1)), ("", "unknown", 0, (0, 0, 0)),
    ("hospital", "pure_english", 1.0, (0, 0, 1)), ("mama hospital eke appointment ganna enna", "singlish", 1.0, (0.75, 0.25, 0.25)), ("amma fever hariyata thiyenawa da", "singlish", 0.8, (0.5, 0, 0.5)),
]


def test_romanized(on):
    got = on([r[0] for r in ROMANIZED], romanized.classify)
    for (text, kind, confidence, scores), g in zip(ROMANIZED, got):
        assert (g["classification"], round(g["confidence"], 4)) == (kind, confidence), text
        assert tuple(round(g[f"{k}_score"], 4) for k in ("singlish", "tamilish", "english")) == scores, text
    switches = [[(s["start_pos"], s["from_lang"], s["to_lang"], s["text_segment"]) for s in g["code_switches"]] for g in got]
    assert switches[0] == [(10, "singlish", "english", "dengue"), (24, "english", "singlish", "eka")]
    assert switches[3] == [(14, "english", "tamilish", "enga"), (26, "tamilish", "singlish", "hospital"), (35, "singlish", "tamilish", "la")]
    assert got[8]["matched_markers"] == ["mama", "ganna", "enna", "enna"] and switches[1] == []
    targets = on([r[0] for r in ROMANIZED], lambda t: romanized.translation_language(romanized.classify(t)))
    assert targets[0] == "sinhala" and targets[3] == "tamil" and targets[5] is None


def test_preprocessing(on):
    assert on(["a\tb", "a  b\n\n\n\nc ", None, "é"], preprocess.clean) == ["ab", "a b\n\nc", "", "é"]
    got = on(["Call me at 0771234567", "call +94771234567", "id 123456789v", "200012345678", "mail a.b@x.lk", "123-456-7890@x.com and", "Go to the hosiptal"], preprocess.preprocess)
    assert [g["cleaned"] for g in got] == ["call me at [REDACTED]", "call +94771234567", "id [REDACTED]", "[REDACTED]", "mail [REDACTED]", "[REDACTED]nd", "go to the hospital"]
    assert [[p["kind"] for p in g["pii"]] for g in got] == [["PHONE"] * 3, [], ["NIC"], ["NIC"], ["EMAIL"], ["PHONE", "EMAIL"], []]
    assert on(["Hi?! Bye."], preprocess.sentences) == [["Hi?", "!", "Bye."]]
    assert on(["a। b."], lambda t: preprocess.sentences(t, "tamil")) == [["a।", "b."]]
    numbers = on(["38.5C at 8:00 am"], preprocess.health_numbers)[0]
    assert numbers["temperatures"][0] == "38.5C" and "8:00 am" in numbers["times"] and numbers["dates"] == []


def test_intents(on):
    texts = ["Where is the dengue clinic?", "What are the symptoms of dengue?", "clinic eka keeyatada", "Colombo hospital enga irukku", "Contact number for emergency?", "hello?", "hello", ""]
    got = on(texts, intents.classify)
    assert [(g["intent"], round(g["confidence"], 2)) for g in got] == [
        ("asking_location", 0.7), ("asking_symptoms", 0.7), ("asking_time", 1.0), ("asking_location", 1.0), ("asking_contact", 0.7), ("general_info", 0.3), ("unknown", 0.0), ("unknown", 0.0)
    ]
    assert [(s["intent"], s["score"]) for s in got[4]["secondary_intents"]] == [("emergency", 0.7)] and got[5]["matched_patterns"] == ["question_mark"]


def test_intent_examples(spark):
    assert intents.examples(spark).count() == 18 and intents.examples(spark, "emergency").count() == 2


def test_domains(on):
    got = on(["Prevention tips for dengue fever and mosquito control", "booster dose", "hello", "", "x-ray and blood test"], domains.tag)
    assert [(g["primary_domain"], round(g["confidence"], 2)) for g in got[:4]] == [("dengue", 1.0), ("vaccination", 0.9), ("general", 0.3), ("general", 0.0)]
    assert sorted(got[0]["keywords_found"]) == ["dengue", "fever", "mosquito"] and got[1]["keywords_found"].count("booster") == 2
    assert got[4]["primary_domain"] == "laboratory" and on(["එන්නත් දෙන"], lambda t: domains.tag(t, indic_boundaries=True))[0]["primary_domain"] == "vaccination"
    assert on(["dengue"], lambda t: domains.tag(t))[0]["all_domains"][0]["matched_keywords"] == ["dengue"]


def test_entities(on):
    got = on(["i visited national hospital for dengue treatment", "dengue clinic open 8:00 am monday", "crash", "skin rash"], entities.extract)
    rows = [[(e["type"], e["start"], e["end"], e["normalized"], e["confidence"]) for e in g] for g in got]
    assert rows[0] == [("hospital", 10, 27, "National Hospital of Sri Lanka", 0.9), ("disease", 32, 38, "Dengue Fever", 0.9)]
    assert rows[1] == [("clinic", 0, 13, "Dengue Clinic", 1.0), ("time", 19, 26, None, 0.95), ("date", 27, 33, None, 0.95)]
    assert rows[2] == [("symptom", 1, 5, "Rash", 1.0)] and rows[3] == [("symptom", 0, 9, "Rash", 0.9)]
    assert on(["dengue clinic open 8:00 am monday"], lambda t: entities.counts(entities.extract(t))) == [{"clinic": 1, "time": 1, "date": 1}]
    assert on(["rash and cough"], lambda t: entities.summary(entities.extract(t))) == [{"symptom": ["Rash", "Cough"]}]


def test_questions(on):
    text = "National Hospital is located in Colombo. Open 24 hours."
    got = on([text], lambda t: questions.from_content(t, entities.extract(t)))[0]
    assert [(p["question"], p["answer"], p["confidence"]) for p in got] == [
        (f"{q}?", "National Hospital is located in Colombo.", 0.6)
        for q in ("Where is the National Hospital of Sri Lanka", "What are the opening hours of National Hospital of Sri Lanka")
    ]
    faq = on(["Q: What is dengue fever?\nA: A mosquito-borne viral infection."], questions.from_faq)[0]
    assert [(p["question"], p["answer"], p["confidence"]) for p in faq] == [("What is dengue fever?", "A mosquito-borne viral infection.", 0.8)]
    html = on(["<h2>Q: Where do I go?</h2> <p>A: To the <b>clinic</b> nearby</p>"], questions.from_faq)[0]
    assert (html[0]["question"], html[0]["answer"]) == ("Where do I go?", "To the clinic nearby")


def test_questions_late_in_a_long_text(on):
    pair = "<h2>Q: Where do I go?</h2> <p>A: To the clinic nearby</p>"
    for before in (49_980, 120_000):
        found = on(["x" * before + pair], questions.from_faq)[0]
        assert [(p["question"], p["answer"]) for p in found] == [("Where do I go?", "To the clinic nearby")]


def test_fixture_queries_run_over_tables(spark, tmp_path):
    from corpusloom.plans import registry

    text = "National Hospital is located in Colombo. Open 24 hours."
    spark.createDataFrame([(1, f"<p>{text}</p>")], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(2, f"{text} Where is the dengue clinic located?")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 5, "Where is the dengue clinic located?")], "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    ids = lambda name: {r.id for r in registry.QUERIES[name](spark, str(tmp_path)).collect()}
    rows = registry.page_questions(spark, str(tmp_path)).collect()
    assert {(r.kind, r.id) for r in rows} >= {("page", 1), ("document", 2), ("document", -20)}
    assert {r.answer for r in rows if r.id == 1} == {"National Hospital is located in Colombo."}
    assert 3 in ids("intent_scores") and -5 in ids("intent_scores") and 2 in ids("domain_tags") and 2 in ids("preprocess_sentences")


DENSE = {
    "classify": ("mage clinic eka naan hospital ponga dengue koheda enga irukku ", romanized.classify),
    "entities": ("National Hospital dengue fever rash 8:00 am monday 0771234567 clinic ", entities.extract),
    "personal": ("0771234567 a.b@x.lk 123456789v 200012345678 +94771234567 ", preprocess.personal_data),
    "preprocess": ("Go to hosiptal. Call 0771234567! Mail a.b@x.lk? ", preprocess.preprocess),
    "faq": ("<b>Q: What is it now?</b> <p>A: It is a thing here</p> <h2> <b> <p> Q: 1. ", questions.from_faq),
    "unclosed": ("<b>Q: What is <h2> Q: 1. 2) <p> A: ", questions.from_faq),
    "domains": ("dengue fever booster dose blood test vaccine x-ray ", domains.tag),
    "questions": ("Dengue is spread by mosquitoes in town. National Hospital opens daily at eight. ", lambda t: questions.from_content(t, entities.extract(t))),
}


@pytest.mark.parametrize("name", DENSE)
def test_time_grows_with_the_text(spark, name):
    piece, function = DENSE[name]

    def seconds(size):
        rows = spark.createDataFrame([(piece * (size // len(piece)),)], "text string").cache()
        rows.count()
        best = 9e9
        for _ in range(2):
            start = time.monotonic()
            rows.select(function(F.col("text")).alias("r")).write.format("noop").mode("overwrite").save()
            best = min(best, time.monotonic() - start)
        return best

    seconds(1000)
    taken = [seconds(n) for n in (25_000, 50_000, 100_000, 200_000)]
    print(name, [round(t, 2) for t in taken])
    assert all(b <= 2.5 * a + 0.3 for a, b in zip(taken, taken[1:]))


def test_masking_equals_its_statement():
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice("ab1 .@x") for _ in range(rng.randint(0, 60)))
        found = sorted((a, 0, min(len(text), a + rng.randint(1, 25)), "K", "") for a in (rng.randrange(len(text) + 1) for _ in range(rng.randint(0, 8))) if a < len(text))
        plain = text
        for start, _, end, *_ in reversed(found):
            plain = plain[:start] + "[REDACTED]" + plain[end:]
        assert preprocess.masked(text, found) == plain


FAQ = (
    r"<(?:b|strong|h\d)[^>]*>\s*(?:Q[.:]\s*)?(.+?)\s*</(?:b|strong|h\d)>\s*<(?:div|p)[^>]*>\s*(?:A[.:]\s*)?(.+?)\s*</(?:div|p)>",
    r"(?:Question[.:]\s*|Q[.:]\s*)(.+?)[\r\n]+(?:Answer[.:]\s*|A[.:]\s*)(.+?)(?=\Z|\n\n)",
    r"(?:\d+[).]\s*)(.+[?])\s*[\r\n]+(.+?)(?=\Z|\n\n|\d+[).])",
)


def test_faq_forms_equal_their_patterns():
    rng = random.Random(5)
    parts = ["<b>", "</b>", "<p>", "</p>", "<div class=x>", "</div>", "<h2>", "</h2>", "Q: ", "A. ", "Question: ", "Answer: ", "\n", "\n\n", "1. ", "2) ", "?", " ", "\r\n", "what is all this here", "this is the whole answer", "<"]
    clean = lambda x: re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", x)).strip()
    some = 0
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 18)))
        pairs = [(clean(q), clean(a)) for p in FAQ for q, a in re.findall(p, text, re.I | re.S)]
        expected = [(q, a) for q, a in pairs if len(q) > 10 and len(a) > 10]
        assert [(p["question"], p["answer"]) for p in questions.faq_of(text)] == expected, text
        some += bool(expected)
    assert some > 100


def test_hashes(on):
    a, b, c, d = on(["Hello,  World!", "hello world", "a - b", "a b"], hashing.content_hash)
    assert a == b and a.startswith("b94d27b9934d") and c != d
    pairs = [("a b c", "a b c d e", "Added ~2 words"), ("a b c d e", "a b c", "Removed ~2 words"), ("a", "b", "Minor changes (same word count)")]
    for old, new, summary in pairs:
        assert on([new], lambda t, old=old: hashing.diff_summary(F.lit(old), t)) == [summary]


def test_scores(spark):
    url = "https://www.epid.gov.lk/x"
    score = lambda given, level, days, demand: spark.range(1).select(scoring.priority(F.lit(url), F.lit(level), F.lit(days), F.lit(demand), F.lit(given).cast("double"))).first()[0]
    assert score(0.95, "high", 90, 1.0) == 1.0 and round(score(0.95, "high", 0, 0.8), 6) == 0.765 and round(score(0.7, "medium", 0, 0.0), 6) == 0.41
    assert round(score(0.85, "none", 15, 0.0), 6) == 0.605 and round(score(None, "high", 0, 0.0), 6) == round(0.32 + 0.285, 6)
    links = {"http://www.epid.gov.lk/": 0.3, "http://www.epid.gov.lk/dengue/report.pdf": 0.75, "http://www.health.gov.lk/clinic-schedule.pdf": 1.0, "https://example.com/health-report.pdf": 0.25}
    for link, expected in links.items():
        assert round(spark.range(1).select(scoring.link_relevance(F.lit(link), F.lit(""))).first()[0], 6) == expected, link


def test_assets(spark, on):
    assert on(["https://x.org/report.pdf", "https://x.org/photo.png", "https://example.com/", "https://x.org/a.zip"], pages.asset_type) == ["pdf", "image", "html", "unknown"]
    internal = F.array(*[F.lit(f"https://x.org/{n}") for n in ("a.pdf", "b.pdf", "c.jpg", "d")])
    got = spark.range(1).select(pages.segregate(internal, F.array(F.lit("i.png"))).alias("s")).first()["s"]
    assert (got["counts"]["pdf"], got["counts"]["images"], got["counts"]["documents"], got["ocr_required"]) == (2, 2, 0, True)
    assert on(["https://h.org/p/a.pdf?x=1"], lambda u: pages.storage_path(F.lit("pdf"), F.lit("c1"), u)) == ["pdfs-raw/c1/a.pdf?x=1"]


def test_translation(spark, on):
    assert on(["x"], translate.multilingual) == [{"sinhala": "[sinhala] x", "tamil": "[tamil] x", "english": "[english] x"}]
    df = spark.createDataFrame([("ab",), (" ",), (None,)], "text string")
    out = translate.with_model(df, lambda: lambda xs: [x.upper() for x in xs], "text", "up")
    assert sorted(r["up"] for r in out.collect()) == ["", "", "AB"]


alphabet = st.text(alphabet="aB1_ .,éක්ෙக்\n\t@x", max_size=25)


def test_primitives_equal_pythons(on):
    @settings(max_examples=6, deadline=None)
    @given(st.lists(alphabet, min_size=5, max_size=20))
    def check(texts):
        assert on(texts, words) == [re.findall(r"\w+", t) for t in texts]
        assert on(texts, ascii_tokens) == [re.findall(r"\b[a-z]+\b", t.lower()) for t in texts]
        found = on(texts, lambda t: spans(t, whole("x")))
        assert [[(s["start"], s["end"]) for s in f] for f in found] == [[m.span() for m in re.finditer(r"\bx\b", t)] for t in texts]
        assert on(texts, preprocess.compose) == [unicodedata.normalize("NFC", t) for t in texts]

    check()


def test_each_holds_a_piece_of_the_rows_at_a_time():
    import pyarrow as pa

    from corpusloom.functions import textkit

    texts = pa.array([None if i % 7 == 0 else f"x{i}" for i in range(3 * textkit.PIECE + 5)])
    assert textkit.each(lambda t: t, pa.string(), texts).equals(texts)
    assert textkit.each(lambda t: t, pa.string(), texts.slice(3, 0)).equals(pa.array([], pa.string()))


def test_intents_need_a_word_of_their_pattern(on):
    assert intents.needed(r"how\s+to\s+(?:get|make|book)\s+(?:an?\s+)?appointment") == ["appointment"]
    assert intents.needed(r"(?:closing|opening|close|open)\s*(?:hours?|time)?") == ["closing", "opening", "close", "open"]
    assert intents.needed(r"what\s+(?:is|are)\s+the\s+symptoms?") == ["symptom"] and intents.needed("1990|911|help") == ["1990", "911", "help"]
    rows = on(["HOW TO\nGET an Appointment", "directions", "What Is", "ſchedule"], intents.classify)
    assert [g["intent"] for g in rows] == ["asking_appointment", "asking_location", "general_info", "unknown"]


def test_python_is_given_marked_texts_alone(on):
    texts = ["no mark", None, "", "call 0771234567", "a@b.lk", "๑๒๓๔๕๖๗๘๙๐", "é"]
    got = on(texts, preprocess.personal_data)
    assert [None if g is None else [p["kind"] for p in g] for g in got] == [[], None, [], ["PHONE"] * 3, ["EMAIL"], ["PHONE"] * 2, []]
    assert not preprocess.matches("x" * 50) and preprocess.matches("a@b.lk")[0][3] == "EMAIL"
