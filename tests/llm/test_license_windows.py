"""License templates wrapped over lines, against all windows."""

import random

from corvine.llm import license_scan

EVERY = license_scan.TEMPLATES + license_scan.NOTICES


def _plain(text):
    words = license_scan.words_of(text)
    out = {}
    for label, template in EVERY:
        t = license_scan.words_of(template)
        need = license_scan._need(len(set(t)), license_scan.THRESHOLD)
        n = license_scan.window_of(len(t))
        common = max(len(set(t) & set(words[s : s + n])) for s in range(max(1, len(words) - n + 1)))
        if common >= need:
            out[label] = max(out.get(label, 0), common / len(set(t)))
    return out


def test_rows_do_not_share_labels(spark):
    notice = "filler words\nreleased under the\nmit license"
    rows = [(None, notice), (None, "plain text"), (1, "plain text"), (1, notice), (2, None), (3, "\u0130 RELEASED \u212aelvin"), (4, "released words " * 20_000 + "under the mit license")]
    got = sorted((str(r.doc_id), r.labels, r.n_words) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted([("None", "mit", 7), ("None", "", 2), ("1", "", 2), ("1", "mit", 7), ("2", "", 0), ("3", "", 3), ("4", "mit", 40_004)])


def test_wrapped_notices(spark):
    rnd = random.Random(3)
    texts = []
    for _, template in EVERY:
        for change in range(4):
            words = template.split()
            if change == 1:
                words[rnd.randrange(len(words))] = "other"
            elif change == 2:
                words.insert(rnd.randrange(len(words)), "extra")
            elif change == 3:
                rnd.shuffle(words)
            texts.append("before the license of it " * rnd.randrange(3) + "".join(w + rnd.choice(["\n", "\n# ", " "]) for w in words) + "and with after" * rnd.randrange(2))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs, phrases={"no such phrase": "none"}).collect()}
    for i, text in enumerate(texts):
        want = _plain(text)
        assert got[i].labels == ",".join(sorted(want)), text
        assert abs(got[i].score - max(want.values(), default=0)) < 1e-12
    wrapped = [i for i, t in enumerate(texts) if i % 4 == 0 and "\n" in t]
    assert len(wrapped) > 12 and all(got[i].labels for i in wrapped)
