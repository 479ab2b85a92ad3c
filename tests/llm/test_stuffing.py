import random

import pytest

from folioflow.llm import stuffing as S

PROSE = {
    "en": "The river carries the sand to the sea, and the sand that it leaves behind is what the wind lifts from the beach.",
    "de": "Der Fluss trägt den Sand in das Meer, und der Sand, den er auf dem Strand lässt, wird von dem Wind in die Höhe getragen.",
    "fr": "La rivière porte le sable dans la mer, et le sable que les vagues laissent sur la plage est pris par le vent.",
    "es": "El río lleva la arena al mar, y la arena que las olas dejan en la playa es lo que el viento se lleva con él.",
    "hi": "यह नदी रेत को समुद्र में ले जाती है और वह रेत किनारे पर रहती है जहाँ हवा उस को उठाती है।",
}
KEYWORDS = ["river", "sand", "beach", "Sand", "arena", "pdf", "online"]


def stuffing(r, kind, n=110):
    if kind == "keywords":
        return " ".join(r.choice(KEYWORDS) for _ in range(n))
    if kind == "commas":
        return ", ".join(f"{r.choice(KEYWORDS[:3])} {r.choice(['free', 'best', 'pdf'])}" for _ in range(n))
    if kind == "lines":
        return "\n".join(f"{r.choice(KEYWORDS[:3])} {r.choice(['free', 'best', 'pdf'])}" for _ in range(n))
    if kind == "hashtags":
        return " ".join("#" + r.choice(KEYWORDS) for _ in range(n))
    if kind == "links":
        return "\n".join(f"[{r.choice(KEYWORDS)} {i}](https://x{i}.example/{i})" for i in range(n))
    if kind == "bare links":
        return "\n".join(f"https://x{i}.example/{r.choice(KEYWORDS)}" for i in range(n))
    if kind == "products":
        return "\n".join(f"{r.choice(KEYWORDS)} chart | SKU {i} | 9.99 | in stock | {r.choice(KEYWORDS)}" for i in range(n))
    return "\n".join(f"<a href='https://x{i}.example/'>{r.choice(KEYWORDS)}</a>" for i in range(n))


HONEST = {
    "contents": "Contents\n" + "\n".join(f"1.{i} The sand of the beach ........ {i}" for i in range(30)),
    "index": "Index\n" + "\n".join(f"{w}, {i}, {i + 3}" for i, w in enumerate("acid base cell dune earth flora gas heat iron joule kelvin light mass nerve ocean plant quartz root soil tide".split())),
    "key": "Answer key\n" + " ".join(f"{i}. (b)" for i in range(60)),
    "drill": "Say it aloud.\n" + "\n".join(f"7 times {i} is {7 * i}." for i in range(30)),
    "reading list": "Further reading\n" + "\n".join(f"The book on the dunes is what you want to read if the wind is of interest. See https://x{i}.example/{i} for more." for i in range(10)),
    "tags": "\n".join([PROSE["en"]] * 1 + ["When the tide is out, the beach is wide and the birds look for food in the sand."] * 1 + ["Tags: sand, beach, river, wind, sea"]),
    "short": "river sand beach",
    "formula": "E = m c^2",
}


@pytest.mark.parametrize("around", [0, 2])
@pytest.mark.parametrize("kind", ["keywords", "commas", "lines", "hashtags", "links", "bare links", "products", "anchors"])
def test_pages_of_stuffing(spark, kind, around):
    r = random.Random(1)
    docs = [(i, "\n\n".join([PROSE[lang]] * around + [stuffing(r, kind)] + [PROSE[lang]] * (around // 2)), lang) for i, lang in enumerate(PROSE)]
    docs += [(100 + i, "\n\n".join([p, p.replace("sand", "clay")]), lang) for i, (lang, p) in enumerate(PROSE.items())]
    got = {x.doc_id for x in S.stuffed_pages(spark.createDataFrame(docs, "doc_id bigint, text string, lang string")).collect()}
    assert got == set(range(len(PROSE)))


def test_honest_pages_and_odd_rows(spark):
    docs = [(i, t, "en") for i, t in enumerate(HONEST.values())] + [(50 + i, (p + " ") * 20, "xx") for i, p in enumerate(PROSE.values())]
    docs += [(90, None, None), (91, " ", None), (92, "", "en"), (93, "x" * 100_000, None), (94, PROSE["en"] + "\n\n" + "#sand " * 5, None)]
    spam = "sand beach " * 50
    docs += [(None, spam, "en"), (95, spam, None), (95, spam, None), (96, "\n".join([PROSE["en"]] * 12) + "\n" + spam, "en")]
    df = spark.createDataFrame([d + ("a", 1.0) for d in docs], "doc_id bigint, text string, lang string, language string, words double")
    assert [x.doc_id for x in S.stuffed_pages(df).collect()] == [95]


def test_language_is_told_by_the_text():
    for lang, p in PROSE.items():
        assert S.measure(p, "xx")[0] == lang
    assert S.measure("12345 !!!", " EN ")[0] == "en" and S.measure("12345", None)[0] == "und"


def test_empty(spark):
    assert S.stuffed_pages(spark.createDataFrame([], "doc_id bigint, text string, lang string")).count() == 0


def test_repeated_lines_are_no_prose(spark):
    ad = "best physics notes for class at low price"
    worksheet = "\n".join(f"Explain how the wind lifts {w} from the beach and where it goes.\nGive a reason for your answer" for w in "sand salt silt foam ash dust".split())
    docs = [(0, "\n".join([ad] * 200), "en"), (1, "\n".join([PROSE["en"]] + [ad, "the best of the notes for you"] * 40), "en"), (2, "\n".join([PROSE["en"]] * 30), "en"), (3, worksheet, "en"), (4, f"{PROSE['en']}\n{ad}", "en")]
    assert {x.doc_id for x in S.stuffed_pages(spark.createDataFrame(docs, "doc_id bigint, text string, lang string")).collect()} == {0, 1}


def test_copies_and_separators_lower_the_bound(spark):
    base = dict.fromkeys(S.FIELDS, 0.0) | {"words": 100.0, "chars": 600.0, "pool_share": 1.0, "pool_words": 100.0, "pool_top": 0.4, "pool_repeats": 0.55}
    usual = base | {"pool_share": 0.1, "pool_repeats": 0.5, "separators": 0.1, "function_share": 0.5}
    rows = [base, base | {"duplicate_share": 0.3}, base | {"separators": 0.35}, base | {"separators": 0.25}, *[usual] * 20]
    df = spark.createDataFrame([(i, "en", *(r[f] for f in S.FIELDS)) for i, r in enumerate(rows)], "doc_id bigint, language string, " + ", ".join(f"{f} double" for f in S.FIELDS))
    assert {r.doc_id for r in S.stuffed(df).collect()} == {1, 2}


OTHERS = {
    "pl": ["Rzeka niesie piasek do morza i zostawia go na brzegu.", "Wiatr podnosi ten piasek i przenosi go na pole.", "Na plaży nie ma trawy, bo sól jest w ziemi.", "To jest wzór, który opisuje ruch wody w rzece.", "Uczeń mierzy, jak szybko płynie woda, a potem to zapisuje."],
    "it": ["Il fiume porta la sabbia al mare e la lascia sulla riva.", "Il vento alza la sabbia e la porta nei campi.", "Sulla spiaggia non c'è erba perché nel suolo c'è il sale.", "Questa è la formula che descrive il moto dell'acqua.", "Lo studente misura con un filo come scorre l'acqua e poi lo scrive."],
    "nl": ["De rivier brengt het zand naar de zee en laat het op het strand.", "De wind tilt het zand op en brengt het naar de velden.", "Op het strand is er geen gras omdat er zout in de grond is.", "Dit is de formule die de beweging van het water beschrijft.", "De leerling meet hoe snel het water stroomt en schrijft dat op."],
    "sv": ["Floden för sanden till havet och lämnar den på stranden.", "Vinden lyfter sanden och för den till fälten.", "På stranden finns det inget gräs för att det är salt i marken.", "Det är den formel som beskriver hur vattnet rör sig.", "Eleven mäter hur fort vattnet rinner och skriver det i boken."],
    "pt": ["O rio leva a areia para o mar e a deixa na praia.", "O vento levanta a areia e a leva para os campos.", "Na praia não há erva porque há sal no solo.", "Esta é a fórmula que descreve o movimento da água.", "O aluno mede a velocidade com que a água corre e a escreve no caderno."],
}


@pytest.mark.parametrize("n", [4, 60])
def test_languages_without_a_fixed_list(spark, n):
    r = random.Random(7)
    docs, spam = [], set()
    for k, (lang, sentences) in enumerate(OTHERS.items()):
        for i in range(n):
            docs.append((1000 * k + i, " ".join(r.sample(sentences, 4)) + "\n" + " ".join(r.sample(sentences, 3)), lang))
        words = [w.strip(".,").lower() for s in sentences for w in s.split() if len(w) > 6][:7]
        for i, t in enumerate((" ".join(r.choice(words) for _ in range(120)), "\n".join(f"{r.choice(words)} {r.choice(words)}" for _ in range(80)), ", ".join(r.choice(words) for _ in range(90)))):
            docs.append((1000 * k + 900 + i, t, lang))
            spam.add(1000 * k + 900 + i)
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    learned = S.learned_words(df)
    assert set(learned) == (set(OTHERS) if n >= S.LEARN_DOCS else set())
    assert n < S.LEARN_DOCS or {"na", "to"} <= set(learned["pl"]) and {"het", "de"} <= set(learned["nl"])
    assert {x.doc_id for x in S.stuffed_pages(df).collect()} == spam
