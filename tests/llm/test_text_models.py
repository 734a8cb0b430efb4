import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from netvitals.llm import toxicity as tox
from netvitals.llm.language_id import identify_corpus, train_languages, visible
from netvitals.llm.licenses import TEMPLATES, Templates, coordinate, scan_licenses, word_shingles
from netvitals.llm.queries import PIECES
from netvitals.llm.sentencepiece_codec import as_read, decode_documents, encode_documents, encode_texts, load_vocabulary
from netvitals.llm.words import utf8

SF = "/root/testdata/sf0.01"


# --- toxicity ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    return docs, labels, tox.train(docs, labels)


def test_obfuscated_words_are_restored(spark, documents):
    words = "idiot stupid loser trash moron worthless pathetic clown hello street running"
    table = documents(*[(i, words) for i in range(30)])
    restore = tox.Restorer(tox.character_model(table))
    for seen, meant in {
        "1d10t": "idiot", "i.d-i_o.t": "idiot", "stuuuupid": "stupid", "l0$er": "loser", "tr@sh": "trash",
        "m0r0n": "moron", "w0rthl3ss": "worthless", "pathetiiiic": "pathetic", "street": "street",
    }.items():
        assert restore(seen.encode()) == meant.encode()
    data, offsets = utf8(pa.array(["I D I O T, plain", "x s t u p i d", None, "tr@sh!!"]))
    raw, start, end, text = tox.restored_words(data, offsets, restore)
    found = {(int(t), bytes(raw[a:b]).decode()) for a, b, t in zip(start, end, text)}
    assert {(0, "idiot"), (0, "plain"), (1, "x"), (1, "stupid"), (3, "trash")} <= found


SENTENCE = "you are a stupid idiot and a pathetic loser"


def test_toxic_text_is_told_however_it_is_written(trained):
    _, _, model = trained
    stretched = " ".join(w[0] + w[1] * 60 + w[1:] if len(w) > 1 else w for w in SENTENCE.split())
    dashes = " ".join(w[0] + "-" * 50 + w[1:] for w in SENTENCE.split())
    toxic = [
        SENTENCE, stretched, dashes, "s t u p 1 d i d 1 0 t a n d p a t h e t i c l o s e r", "stu pid id iot path etic lo ser",
        "id1 0t st up1d lo s3r", "!diot $tup1d l0$er", "s t u p i d  i d i o t",
    ]
    scores = model.score(pa.array(toxic))
    assert (scores >= 0.5).all(), list(zip(toxic, scores))
    clean = ["of the in to it is at 5 10 20 in a", "", None, "a b c d e f g", "2024 1 5 @$$", "x" * 500, "0 " * 300]
    assert (model.score(pa.array(clean)) < 0.5).all()


def test_spaces_are_read_as_boundaries_or_nothing(spark, documents):
    words = "idiot stupid loser the dog in of it is to and he".split()
    texts = [" ".join(random.Random(i).sample(words, len(words))) for i in range(60)]
    restore = tox.Restorer(tox.character_model(documents(*enumerate(texts))))
    for seen, meant in {
        "s t u p i d": "stupid", "stu pid id iot": "stupid idiot", "1 d 1 0 t": "idiot", "in the dog": "in the dog",
        "he is s t u p 1 d": "he is stupid", "lo ser of it": "loser of it",
    }.items():
        assert restore(seen.encode()) == meant.encode()
    data, offsets = utf8(pa.array(["the dog of 5 10", "s t u p i d", "stu", "pid", "in s.t.u.p.i.d the"]))
    raw, start, end, text = tox.restored_words(data, offsets, restore)
    found = [(int(t), bytes(raw[a:b]).decode()) for a, b, t in zip(start, end, text)]
    assert sorted(found) == [
        (0, "10"), (0, "5"), (0, "dog"), (0, "of"), (0, "the"), (1, "stupid"), (2, "stu"), (3, "pid"),
        (4, "in"), (4, "stupid"), (4, "the"),
    ]


def test_long_tokens_are_decoded_in_linear_time(trained):
    import time

    restore = tox.Restorer(trained[2].characters)
    start = time.perf_counter()
    assert len(restore(b"1d10t-" * 20_000)) > 20_000
    assert time.perf_counter() - start < 20


def test_viterbi_is_the_best_of_all_readings(spark, documents):
    from itertools import product

    model = tox.character_model(documents((1, "salt malt halo tool atoll lasso"), (2, "tall all small loot")))
    restore = tox.Restorer(model)
    for token in (b"t00l", b"s@lt", b"l4$$0", b"ta11", b"h.a.l.o", b"aaall"):
        every = product(*(restore.choices(token, i) for i in range(len(token))))

        def worth(reading):
            s, total = [0, 0], 0.0
            for letter, chance in reading:
                total += chance
                if letter:
                    s.append(int(tox._SYMBOL[letter[0]]))
                    total += float(model[s[-3], s[-2], s[-1]])
            return total + float(model[s[-2], s[-1], 0])

        best = max(map(worth, map(list, every)))
        again = [list(r) for r in product(*(restore.choices(token, i) for i in range(len(token))))]
        mine = [r for r in again if b"".join(x for x, _ in r) == restore(token)]
        assert max(map(worth, mine)) == pytest.approx(best)


def test_held_out_labels_are_told(spark, trained):
    docs, labels, model = trained
    scored = tox.toxicity_scores(docs.select("doc_id", "text"), model)
    rows = scored.join(labels, "doc_id").filter(tox.held_out(F.col("doc_id"))).collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in rows)
    assert len(rows) > 50 and right / len(rows) > 0.93
    assert sum(r.score >= 0.5 for r in rows if r.toxic == 0) <= 1
    assert all(0 <= r.score <= 1 for r in rows)


def test_score_edge_rows(spark, trained, documents):
    _, labels, model = trained
    table = documents((1, None), (2, ""), (3, "z" * 300_000), (None, "\t \n"), (5, "ok"), (5, "ok")).withColumn("score", F.lit("x"))
    rows = tox.toxicity_scores(table, model).collect()
    assert len(rows) == 6 and all(0 <= r.score < 0.5 for r in rows)
    none = labels.limit(0)
    assert all(r.score < 1e-6 for r in tox.score_documents(table.drop("score"), none).collect())
    assert tox.score_documents(table.limit(0), labels).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    assert tox.reject_toxic(table, odd).columns == table.columns


# --- SentencePiece -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The public pieces under the library's unigram model, with finite scores for blanks."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto()
    model.ParseFromString(open(PIECES, "rb").read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        if p.score < -1e8:
            p.score = -33_000 - len(p.piece)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_encoding_is_that_of_the_library(spark, unigram):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=unigram)
    v = load_vocabulary(unigram)
    texts = ["", "a", " ", "  Hello  wörld\n\tx ", "ﬁ ① é", "x" * 300 + "ab" * 50, None, "日本語の文章 です", "😀 ok", "a\x00b", "é"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    data, offsets = as_read(*utf8(pa.array(texts)))
    ids, counts = encode_texts(v, data, offsets)
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == library.encode(text or ""), text


def test_round_trip_of_a_table(spark, documents):
    texts = [None, "", "▁literal▁marker", "tab\tnew\nline", "long " * 40_000, "nospace" * 5000, "日本 語"]
    table = documents(*enumerate(texts), (3, texts[3])).withColumn("n_tokens", F.lit("clash")).withColumn("size", F.lit(1))
    rows = encode_documents(table, PIECES)
    assert set(rows.columns) == {"doc_id", "lang", "source", "n_chars", "size", "token_ids", "n_tokens", "round_trip"}
    got = rows.collect()
    assert len(got) == 8 and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in got)
    back = {r.doc_id: r.text for r in decode_documents(rows, PIECES).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}
    assert encode_documents(table.limit(0), PIECES).count() == 0


# --- licenses ----------------------------------------------------------------------------


def test_licenses_against_containment_of_whole_texts(spark, documents, prose):
    apache = TEMPLATES["Apache-2.0"][0]
    permission = TEMPLATES["MIT-permission"][0].split()
    worn = " ".join(w if i not in (5, 40) else "xx" for i, w in enumerate(permission))
    torn = " ".join(permission[:25])
    rows = [
        (1, f"{prose(300, 1)}\n{apache}\n{prose(100, 2)} {apache.upper()}"), (2, worn), (3, torn + " " + prose(50, 3)), (4, None), (5, ""),
        (6, "Licensed under"), (7, prose(3000, 5) + " Licensed under CC BY-NC 4.0"), (8, apache[:-1]), (None, apache), (8, apache[:-1]),
    ]
    docs = documents(*rows).withColumn("license", F.lit("clash"))
    got = sorted(scan_licenses(docs).collect(), key=repr)
    want = []
    for i, t in rows:
        for name, forms in TEMPLATES.items():
            share = max(len(word_shingles(f, 5) & word_shingles(t or "", 5)) / len(word_shingles(f, 5)) for f in forms)
            if share >= 0.8:
                want.append((i, name, share))
    assert sorted(((r.doc_id, r.license, r.containment) for r in got), key=repr) == sorted(want, key=repr)
    (one,) = [r for r in got if r.doc_id == 1]
    assert one.passages == 2
    text = dict(rows[:1])[1].encode()
    assert text[one.first_byte : one.last_byte].decode() == apache[:-1]
    assert scan_licenses(docs, {}).count() == 0 and scan_licenses(docs.limit(0)).count() == 0


def test_bands_collide_as_promised(prose):
    t = Templates(TEMPLATES, 5, 0.8, 1e-6)
    assert all(30 < n < 500 for n in t.bands.values())
    rng = np.random.default_rng(1)
    for number, values in enumerate(t.sets):
        n, L = len(values), int(t.length[number])
        some = rng.choice(values, int(np.ceil(0.8 * n)), replace=False)
        window = np.concatenate([some, rng.integers(0, 2**63, 3 * L - len(some), dtype=np.uint64)])
        begin = np.array([0, 0, len(window)])  # an empty text stands before it
        found = {c: (texts, windows, templates) for c, texts, windows, templates in t.retrieve(window, begin)}
        texts, windows, templates = found[L]
        assert (1, 0, number) in zip(texts.tolist(), windows.tolist(), templates.tolist())


def test_bands_retrieve_what_brute_force_signatures_do():
    """Block minima against the signature of each window's own shingles; most windows hold no
    template shingle and retrieve nothing."""
    t = Templates({"a": ["one two three four five six", "x y z u v w r s t q p"], "b": ["one two three four five seven"]}, 5, 0.8, 1e-6)
    rng = np.random.default_rng(3)
    known = np.concatenate(t.sets)
    hashes = rng.integers(0, 2**63, 400, dtype=np.uint64)
    at = rng.choice(400, 60, replace=False)
    hashes[at] = rng.choice(known, 60)
    begin = np.array([0, 1, 1, 9, 250, 400])  # one shingle, none, few, many
    got = {(c, *p) for c, *columns in t.retrieve(hashes, begin) for p in zip(*(x.tolist() for x in columns))}
    want = set()
    for number, L in enumerate(t.length.tolist()):
        for text in range(5):
            for k in range(-(-int(begin[text + 1] - begin[text]) // L)):
                own = hashes[begin[text] + k * L : min(begin[text] + (k + 3) * L, begin[text + 1])]
                mins = [coordinate(own.astype(np.uint32), m).min() for m in t.mul[: t.bands[L]]]
                if any(a == b for a, b in zip(mins, t.signatures[number])):
                    want.add((L, text, k, number))
    assert got == want and len(got) > 20
    none = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    assert all(len(number) == 0 for _, _, _, number in t.retrieve(none, np.array([0, 1000])))
    assert all(len(number) == 0 for _, _, _, number in t.retrieve(none[:0], np.array([0, 0])))


# --- languages ---------------------------------------------------------------------------


def test_languages_of_pages_and_documents(spark):
    pages, docs = spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
    found = identify_corpus(pages.withColumn("lang", F.lit("clash")), docs).collect()
    assert len(found) == pages.count() + docs.count()
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    told = {r.page_id: re.search(r'lang="(\w+)"', r.html)[1] for r in pages.collect()}
    right = [r.lang == (true[r.doc_id] if r.page_id is None else told[r.page_id]) for r in found]
    assert sum(right) / len(right) > 0.99
    assert all(0.25 <= r.probability <= 1 for r in found)


def test_evidence_decides_where_text_is_silent(spark, documents):
    docs = documents(*[(i, "the of and street with", "en", "a") for i in range(9)], *[(20 + i, "der die das und mit", "de", "b") for i in range(9)])
    pages = spark.createDataFrame(
        [
            (1, "https://x.example.com/q", '<html lang="de"><p>12 34</p></html>'), (2, "https://x.example.com/en/", "<p>1</p>"),
            (3, None, None), (4, "https://host.example.org/a", "<p>und mit der die das</p>"), (5, "https://host.example.org/b", "<b>9</b>"),
            (None, "not an address", ""), (7, "https://x.example.com/q", '<html lang="xx-YY"><script>und mit</script>the street and</html>'),
        ],
        "page_id long, url string, html string",
    )
    got = {(r.page_id, r.doc_id): r for r in identify_corpus(pages, docs).collect()}
    assert len(got) == 25
    lang = {k[0]: r.lang for k, r in got.items() if k[1] is None}
    assert (lang[1], lang[2], lang[4], lang[5], lang[7]) == ("de", "en", "de", "de", "en")
    assert got[(5, None)].text_lang is None and lang[3] in ("de", "en")
    assert visible(b"<style>a</style>x<!-- y -->&amp;z<br/>").split() == [b"x", b"z"]


def test_no_labels_and_no_rows_are_defined(spark, documents):
    pages = spark.createDataFrame([(1, "http://a.org/", "<p>x")], "page_id long, url string, html string")
    docs = documents((1, "some text", None, "a"), (2, None))
    found = identify_corpus(pages, docs)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, None, None, None, None), (None, 1, None, None, None), (None, 2, None, None, None)], key=repr
    )
    assert found.columns == identify_corpus(pages, documents((1, "a b c", "en", "s"))).columns
    assert identify_corpus(pages.limit(0), documents()).count() == 0
    assert train_languages(documents()).languages == []


def test_markup_is_removed_in_linear_time():
    import time

    slow = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[#\w]{1,10};", re.S | re.I)
    rng = random.Random(4)
    parts = [b"<", b">", b"<script>", b"</script >", b"<STYLE a", b"</style>", b"<!--", b"-->", b"a", b"&amp;", b" ", b"<b c='d'>", b"</script"]
    for _ in range(800):
        html = b"".join(rng.choices(parts, k=rng.randrange(14)))
        assert visible(html) == slow.sub(b" ", html), html
    for part in (b"<", b"<script", b"<!--", b"<style>", b"&a", b"</script ", b"<html lang", b"<a ", b"<!-->"):
        start = time.perf_counter()
        visible(part * (1_000_000 // len(part)))
        identify_declared(part * (1_000_000 // len(part)))
        assert time.perf_counter() - start < 2, part


def identify_declared(html):
    from netvitals.llm.language_id import _DECLARED

    return _DECLARED.search(html)


def test_a_document_is_told_without_its_own_counts(spark, documents):
    """Leaving a text out of its label's counts equals training without it."""
    from netvitals.llm.language_id import text_evidence

    rows = [(i, f"the of and {i} street", "en") for i in range(6)] + [(i, f"der die das {i} und", "de") for i in range(6, 12)]
    rows += [(12, "der die das", "en"), (13, "no label here", None), (14, "", "en"), (15, None, "de"), (16, "le la les", "fr")]
    docs = documents(*rows)
    model = train_languages(docs)
    got = {r.doc_id: r.text_ll for r in text_evidence(docs.select("doc_id", "text", "lang"), model, 50.0, False, "lang").collect()}
    for doc_id, text, lang in rows:
        counts = model.counts.copy()
        if lang:
            from netvitals.llm.language_id import LanguageModel, _trigrams

            own = np.bincount(_trigrams(np.frombuffer((text or "").encode(), np.uint8)), minlength=counts.shape[1])
            counts[model.languages.index(lang)] -= own
            data = np.frombuffer((text or "").encode(), np.uint8)
            want = LanguageModel(model.languages, counts).likelihoods(data, np.array([0, len(data)]), 50.0)[0]
            assert np.allclose(got[doc_id], want, rtol=1e-4)
    assert got[12][model.languages.index("de")] > got[12][model.languages.index("en")]


def test_fusion_equals_the_formula(spark):
    """Priors of three levels without the row's own count, evidence and normalisation, by hand."""
    from math import exp, log

    from netvitals.llm.language_id import identify

    rng = random.Random(6)
    languages = ["de", "en", "fr"]
    rows = []
    for i in range(120):
        host = rng.choice([None, "a.x.org", "b.x.org", "y.org", "z.com"])
        domain = host and ".".join(host.split(".")[-2:])
        ll = [0.0] * 3 if i % 9 == 0 else [round(-rng.random() * 20, 3) for _ in range(3)]
        said, code = (rng.choice([None, "de", "en", "fr", "xx"]) for _ in range(2))
        rows.append((i, ll, said, code, host, domain, host and host.split(".")[-1]))
    frame = spark.createDataFrame(
        rows, "id int, text_ll array<double>, declared string, path_code string, host string, domain string, suffix string"
    )
    told = [None if max(r[1]) == min(r[1]) else r[1].index(max(r[1])) for r in rows]
    for r in identify(frame, languages).collect():
        i, ll, said, code, *place = rows[r.id]
        scores = []
        for k in range(3):
            p = 1 / 3
            for depth in (None, 2, 1, 0):
                own = [t for j, t in enumerate(told) if j != i and (depth is None or rows[j][4 + depth:] == tuple(place[depth:]))]
                n = sum(t is not None for t in own)
                p = (sum(t == k for t in own) + 10 * p) / (n + 10)
            s = ll[k] + log(p)
            for x in (said, code):
                if x in languages:
                    s += log(0.9 if x == languages[k] else 0.05)
            scores.append(s)
        best = max(range(3), key=lambda k: (round(scores[k], 12), -k))
        assert r.lang == languages[best]
        assert r.probability == pytest.approx(1 / sum(exp(s - max(scores)) for s in scores))
