import re

from llm_cases import awkward, nothing, words

from caskline.llm import licenses as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in c.PHRASES:
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Released under the MIT License.", "mit\nlicense MIT-LICENSE mitlicense", "GNU General Public License general public", "Apache é License", "the apache license, apache license",
    "permit license", "", "mit", "license mit license",
]


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in c.scan_licenses(docs).collect()}


def test_phrases_equal_brute_force(spark):
    got = scan(spark, TEXTS)
    for k, text in enumerate(TEXTS):
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_phrases_do_not_cross_documents(spark):
    assert [r.n_base for r in scan(spark, ["the mit", "license"]).values()] == [0, 0]


def test_template_spans(spark):
    whole = next(t for label, t in c.TEMPLATES if label == "isc")
    w = whole.split()
    texts = [
        words(200, 1) + " " + whole + " " + words(50, 2),
        " ".join([*w[:12], "indeed", *w[12:]]),
        " ".join([*w[:9], *w[10:]]),
        " ".join(w[:10]),
        " ".join(w[:8]) + " " + words(300, 3) + " " + " ".join(w[8:]),
        whole + " " + words(3, 4) + " " + whole.upper(),
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0.",
        words(400, 5),
    ]
    got = scan(spark, texts)
    assert [got[k].labels for k in range(9)] == ["isc", "isc", "isc", "", "", "isc", "cc-by-nc", "cc-by", ""]
    assert got[0].score == 1 and c.COVERAGE <= got[2].score < 1 and got[8].score == 0


def test_neighbouring_diagonals_are_one_span(spark):
    whole = next(t for label, t in c.TEMPLATES if label == "bsd")
    w = whole.split()
    docs = spark.createDataFrame([(1, 1, "x y " + " ".join([*w[:15], "a", *w[15:]]))], "_id long, _print long, _t string")
    (span,) = c.template_spans(docs).collect()
    assert (span.first, span.last) == (2, 2 + len(w)) and span.label == "bsd"


def test_awkward(spark):
    got = c.scan_licenses(awkward(spark)).collect()
    assert len(got) == 13 and all(r.labels == "" and r.n_base == 0 for r in got)
    assert {r.n_words for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert c.scan_licenses(nothing(spark)).count() == 0
