"""Operators over documents on a small table of odd rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from array import array
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trendloom.llm import langid, mixing, neardup, packing, pii, quality, suffixdedup, toxicity

WORDS = {"en": "the of and to in a is that house river stone walked", "de": "der die und in den von zu das mit sich Straße Haus", "fr": "de la le et les des en un du une maison rivière"}


def _text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "", "", ".", ","]) + (str(rng.randint(0, 999)) if rng.random() < 0.3 else "") for _ in range(n))


def _rows():
    rng = random.Random(7)
    rows = [(i, _text(rng, lang, rng.randint(5, 120)), lang, f"src{i % 6}") for i in range(60) for lang in [rng.choice(list(WORDS))]]
    base = rows[3][1] + " " + _text(rng, "en", 150)
    rows.append((100, base, "en", "src0"))
    words = base.split()
    for k in range(8):
        w = list(words)
        w[10 + 12 * k] = f"changed{k}"
        rows.append((101 + k, " ".join(w), "en", "src0"))
    rows += [(120 + k, base, "en", "src0") for k in range(5)]
    rows += [(200, None, None, None), (201, "", "en", "src1"), (202, " \n\t ", "xx", "odd"), (203, "123 456", None, "src2"), (None, "no id here at all " * 5, "en", "src3"), (204, "日本語 テキスト", "ja", "src4")]
    rows += [(205, "same row twice " * 20, "en", "src5")] * 2
    rows += [(206, "!!! ### %%% " * 40, "en", "src5"), (207, "x" * 30_000, "de", "src5"), (208, _text(rng, "en", 6_000), "en", "src5")]
    rows += [(209, "mail Anna at anna.b@mail.example.org or +49 (30) 1234-5678, 10.0.0.255 card 4111 1111 1111 1111.", "en", "src1")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string, score int")
    return df.repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_counts(docs, rows, empty):
    got = quality.quality(docs).collect()
    assert len(got) == len(rows) and quality.quality(empty).count() == 0

    def expected(text):
        w, lines, seen, covered = words_of(text), [x for x in (text or "").split("\n") if words_of(x)], {}, set()
        for k in range(len(w) - 7):
            seen.setdefault(tuple(w[k : k + 8]), []).append(k)
        for at in seen.values():
            if len(at) > 1:
                covered.update(x for k in at for x in range(k, k + 8))
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed

    want = Counter((r[0], *expected(r[1])) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_language(docs, rows, empty):
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    for i, text, lang, _ in rows:
        if i is not None:
            assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= got[i].score <= 1
            if not re.search(r"[^\W\d_]", text or ""):
                assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            elif lang in WORDS and i < 60:
                assert got[i].lang_pred == lang
    assert langid.identify(empty).count() == 0


def _grams_of(text, p):
    """(n-grams that hold a letter) of a text, character by character."""
    import unicodedata

    low = []
    for c in text:
        if unicodedata.category(c)[0] != "L":
            low.append(" ")
        else:
            low.append(c.lower() if len(c.lower()) == 1 else c)
    t = re.sub(" +", " ", " " + "".join(low) + " ")
    return Counter(t[i : i + n] for n in p.orders for i in range(len(t) - n + 1) if t[i : i + n].strip())


def test_language_against_brute_force(spark):
    """Counts, posteriors and predictions by the textbook formula, n-grams told apart instead of hashed."""
    import numpy as np

    rng, p = random.Random(11), langid.LangIdParams(step_chars=64, block_langs=2)
    langs = ["de", "en", "fr", "l4", "l5"]
    vocab = {k: (WORDS.get(k) or "").split() or [f"{k[1]}{c}q" for c in "abcdefgh"] for k in langs}
    text = lambda k, n: " ".join(rng.choice(vocab[k]) + rng.choice(["", "!", "12", "É"]) for _ in range(n))
    train = [(i, text(k, rng.randint(1, 30)), k) for i, k in ((i, rng.choice(langs)) for i in range(80))]
    asked = [text(rng.choice(langs), rng.randint(1, 40)) for _ in range(40)] + ["", "12 !", None, "a" * 1_000, "ab " * 300]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string")
    known, logp = langid.fit(docs, F.lit(True), p)
    assert known == sorted({k for _, _, k in train})
    blocks = [np.ascontiguousarray(logp[i : i + p.block_langs].T) for i in range(0, len(known), p.block_langs)]
    pred, score = langid.predict_texts(asked, known, blocks, p)
    sums = {k: Counter() for k in known}
    for _, t, k in train:
        sums[k] += _grams_of(t, p)
    n_docs = Counter(k for _, _, k in train)
    for t, got, s in zip(asked, pred, score, strict=True):
        if not re.search(r"[^\W\d_]", t or ""):
            assert (got, s) == ("und", 0.0)
            continue
        z = {}
        for k in known:
            total = sum(sums[k].values()) + p.alpha * p.n_buckets
            z[k] = np.log(n_docs[k] / len(train)) + sum(c * np.log((sums[k][g] + p.alpha) / total) for g, c in _grams_of(t, p).items())
        top = max(z.values())
        post = {k: float(np.exp(v - top)) for k, v in z.items()}
        want = post[got] / sum(post.values())
        assert z[got] > top - 0.5 and abs(s - want) < 0.05, (t, got, s, want)  # two n-grams of few thousand may share a bucket


def test_language_steps_do_not_change_counts():
    rng = random.Random(2)
    text = "".join(rng.choice("ab é1.ß 語") for _ in range(3_000))
    whole = langid.gram_counts([text], langid.LangIdParams())
    assert (whole == langid.gram_counts([text], langid.LangIdParams(step_chars=7))).all() and whole.sum() == sum(_grams_of(text, langid.LangIdParams()).values())


CLASHING = ["row", "lang_pred", "score", "terms", "version", "domain", "language", "src", "copies", "full", "parts", "alloc", "key", "band", "component_id", "kept", "a", "b", "c", "d", "v", "n"]


def test_clashing_columns_are_kept(docs):
    """Columns named like those used inside go through every stage that returns documents, with their values."""
    import corpus_pipeline as c

    own = docs.drop("kept", "score").filter("doc_id IS NOT NULL").select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in CLASHING])
    for name, stage in c.STAGES[:-1]:
        out = stage(own.sparkSession, own, "")
        assert out.columns == own.columns, name
        rows = out.select("doc_id", *CLASHING).collect()
        assert rows and all(r[n] == f"{n}-{r.doc_id}" for r in rows for n in CLASHING), name
    assert c.STAGES[-1][1](own.sparkSession, own, "").count() > 0
    for query in (quality.quality, langid.identify, pii.find, suffixdedup.repeats, mixing.mixture):
        assert query(own).count() > 0
    assert toxicity.toxicity(own, own.select("doc_id", F.lit(1).alias("toxic"), "score")).count() == own.count()


def test_pipeline_of_no_documents(empty):
    import corpus_pipeline as c

    for _, stage in c.STAGES:
        assert stage(empty.sparkSession, empty, "").count() == 0


def test_other_word_lists(docs):
    few = quality.QualityParams(common_words={"en": ["the", "of", "and"], "de": ["der"]}, min_common_words=5)
    assert quality.quality(docs, few).count() == docs.count()


def shingles(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words_of(w)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicates(docs, rows, empty):
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and not r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    assert neardup.near_duplicates(empty).count() == 0


def _component_ids(sets):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def test_near_duplicates_of_a_hot_group(spark):
    """A thousand near copies of one text, most of them on either side of the line, and many that are equal."""
    rng = random.Random(3)
    base = [f"word{k}" for k in range(110)]
    rows = []
    for i in range(1_000):
        w = list(base)
        for k in rng.sample(range(0, 110, 6), rng.choice([0, 1, 1, 2, 2, 3, 4])):
            w[k] = rng.choice(["x", "y", f"own{i}"])
        rows.append((i, " ".join(w)))
    sets = {i: shingles(t) for i, t in rows}
    want = _component_ids(sets)
    assert 10 < len(set(want.values())) < 900
    params = neardup.NearDupParams(bucket_rows=50, star_rows=20)  # hot buckets and centres in parts
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), params).collect()}
    assert got == want


def test_components(spark):
    from trendloom.llm import graph

    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(k, k + 1) for k in range(500, 560)] + [(600, 600), (700, 701), (701, 700)]
    root = {v: v for e in edges for v in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    frame = lambda e: spark.createDataFrame(e, "a long, b long")
    found = graph.components(frame(edges))
    assert {(r.v, r.c) for r in found.collect()} == {(v, find(v)) for v in root}
    more = [(600, 510), (3000, 3001), (700, 701)]
    both = graph.contracted(found, frame(more))
    assert {(r.v, r.c) for r in both.collect()} >= {(r.v, r.c) for r in graph.components(frame(edges + more)).collect()}
    assert graph.components(frame(edges).limit(0)).count() == 0


def test_personal_data(docs, rows, spark, empty):
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    r = got[209]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    text = next(x[1] for x in rows if x[0] == 209)
    spans = [(k, *re.search(p, text).span()) for k, p in (("email", r"anna\S+org"), ("ip", r"10\.0\.0\.255"), ("card", r"4111[ \d]+1"), ("phone", r"\+49[^,]+"))]
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    assert r.spans == joined and r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert got[201].spans == "" and got[200].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = {r.doc_id: r for r in pii.sanitise(docs).collect()}
    assert "anna" not in clean[209].text and clean[209].n_chars == len(clean[209].text) and clean[200].text is None
    assert pii.find(empty).count() == 0
    told = [(i, f"ask Zorblatt via zorb@mail.com item {chr(97 + i) * 4}") for i in range(8)] + [(50 + i, f"a clean report on item number {i}") for i in range(60)]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(told, "doc_id long, text string")).collect()}
    assert "term:4:12" in found[0].spans and found[55].spans == ""


@pytest.mark.parametrize("params", [pii.PiiParams(), pii.PiiParams(send_terms=0)])
def test_terms_of_one_document(spark, params):
    rows = [(0, "please ask Zorblatt via zorb@mail.com today"), (1, "today Zorblatt (zorb@mail.com) we met"), (2, "call Mistral on +49 (30) 1234-5678 today"), (3, None)]
    rows += [(10 + i, f"please ask via mail or call on day {i} today we met") for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs, params).collect()}
    # a name in two documents of 10,004, beside the address; one in one document, beside the number
    assert (found[0].spans, found[1].spans, found[2].spans) == ("email:24:37,term:11:19", "email:16:29,term:6:14", "phone:16:34,term:5:12")
    assert sum(r.n_terms for r in found.values()) == 3 and len(found) == len(rows)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs, params).collect()}
    assert clean[0] == "please ask  via [EMAIL] today" and clean[1] == "today  ([EMAIL]) we met" and clean[2] == "call [Name] on [PHONE] today" and clean[3] is None


def _plain_spans(text):
    """Base spans by the contract's own patterns."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def ok(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))
            return 16 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if ok(k, m[0])] for k, p in patterns.items()}


def test_base_patterns_on_random_texts():
    rng = random.Random(6)
    pieces = ["1.2.3.4", "10.0.0.256", "001.002.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1", "a@b.c", "a@b", "x.y@z-1.co.uk", " ", ".", "-", "+", "7", "12", "@", "é", "(", ")", "\n", "1" * 20]
    for _ in range(4_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(text) == _plain_spans(text), text


def test_disclosure_against_brute_force(spark):
    """Terms and their disclosure by counting every pair over every document."""
    import math

    rng, p = random.Random(12), pii.PiiParams(near=3)
    names, fill = ["Zorba", "Quill", "Mira", "Tove"], ["ask", "today", "about", "the", "parcel", "please", "again", "river"]
    rows = []
    for i in range(400):
        words = [rng.choice(fill) for _ in range(rng.randint(3, 12))]
        if rng.random() < 0.15:
            k = rng.randrange(len(names))
            words[1:1] = [names[k] if rng.random() < 0.8 else "someone", f"p{k}@mail.org" if rng.random() < 0.95 else f"+49 30 {k}123456"]
        rows.append((i, " ".join(words)))
    rows += [rows[7], (None, rows[3][1]), (401, None), (402, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near, having, texts = {}, {}, {r: (r[1] or "") for r in set(rows)}
    for r, text in texts.items():
        words = [(m[0].lower(), *m.span()) for m in re.finditer(r"[^\W\d_]{3,}", text)]
        for kind, spans in _plain_spans(text).items():
            for a, b in spans:
                value = text[a:b].lower() if kind == "email" else re.sub("[^0-9]+", "." if kind == "ip" else "", text[a:b])
                having.setdefault((kind, value), set()).add(r)
                for w in {w for w, _, e in [x for x in words if x[2] <= a][-p.near :]} | {w for w, s, _ in [x for x in words if x[1] >= b][: p.near]}:
                    near.setdefault((w, kind, value), set()).add(r)
    n = len(rows)  # documents of the table; repeated rows are one in the other counts
    seen = Counter(w for _, text in rows for w in {w.lower() for w in re.findall(r"[^\W\d_]{3,}", text or "")})
    want = {}
    for (w, kind, value), with_it in near.items():
        n_te, n_e = len(with_it), len(having[kind, value])
        d = math.log(n_te * n / ((max(seen[w], n_te) + 0.5) * n_e)) / math.log(n / n_e)
        if d >= p.generalise_at:
            want[w] = max(want.get(w, 0), d)
    got = {r.term: (r.action, r.disclosure) for r in pii.revealing_terms(pii._prepared(docs), p).collect()}
    assert want and set(got) == set(want)
    for w, (action, d) in got.items():
        assert abs(d - want[w]) < 1e-9 and action == ("remove" if d >= p.remove_at else "generalise")


def test_viterbi_against_all_spellings():
    """The decoder's spelling is the best of all that the channel allows."""
    import itertools

    import numpy as np

    rng = random.Random(3)
    counts = np.zeros(toxicity.N_CHARS**3)
    for word in "stupid idiot loser boot tool lilt sat so is it a pass".split():
        x = [0, 0, *(toxicity._INDEX[c] for c in word), 0]
        for a, b, c in zip(x, x[1:], x[2:], strict=False):
            counts[(a * toxicity.N_CHARS + b) * toxicity.N_CHARS + c] += 5
    model = toxicity.CharModel(counts)

    def ways(text, i):
        """(letter or None, cost) of a character."""
        c, again = text[i], i and text[i] == text[i - 1]
        letters = [(c, 0.0)] if c in toxicity._INDEX else [(x, toxicity.SIGN_COST) for x in toxicity.SIGNS.get(c, "")]
        if not letters:
            return [(None, toxicity.DROP_COST), (" ", 0.0)]
        out = [(x, cost + (toxicity.KEEP_REPEAT_COST if again else 0.0)) for x, cost in letters]
        if again:
            out += [("same:" + x, toxicity.REPEAT_COST) for x, _ in letters]
        if letters[0][1] and not c.isdigit():
            out.append((None, toxicity.DROP_SIGN_COST))
        return out

    def value(choice):
        score, state, out = 0.0, (0, 0), []
        for what, cost in choice:
            if what is None:
                score -= cost
            elif what == " ":
                if not state[1]:
                    return None
                score, state = score + float(model.logp[state[0], state[1], 0]), (0, 0)
                out.append(" ")
            elif what.startswith("same:"):
                if not out or out[-1] != what[5:]:
                    return None
                score -= cost
            else:
                i = toxicity._INDEX[what]
                score, state = score + float(model.logp[state[0], state[1], i]) - cost, (state[1], i)
                out.append(what)
        return score + (float(model.logp[state[0], state[1], 0]) if state[1] else 0.0), "".join(out).strip()

    for _ in range(150):
        text = "".join(rng.choice("stiopl10!$ .s") for _ in range(rng.randint(1, 6)))
        best = max(v for v in map(value, itertools.product(*(ways(text, i) for i in range(len(text))))) if v)
        found = model.decode(text)
        same = [v for v in map(value, itertools.product(*(ways(text, i) for i in range(len(text))))) if v and v[1] == found]
        assert same and max(same)[0] > best[0] - 1e-3, (text, found, best)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def test_email_runs():
    rng = random.Random(1)
    for _ in range(5_000):
        t = "".join(rng.choice("a@.-é+ ") for _ in range(rng.randint(0, 16)))
        assert pii.emails(t) == [m.span() for m in EMAIL.finditer(t)]
    assert pii.emails("a" * 200_000) == []


def test_toxicity(docs, spark, empty):
    model = toxicity.CharModel(toxicity.char_counts(docs))
    bad = [(1000 + i, f"you are a vile gremlin and the house is in the river {i} " * 2) for i in range(40)] + [(2000 + i, f"the river and the stone house in the valley {i} " * 2) for i in range(60)]
    texts = spark.createDataFrame(bad, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    labels = spark.createDataFrame([(i, int(i < 2000)) for i, _ in bad] + [(5, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(texts, labels).collect()}
    held = [i for i, _ in bad if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(got[i].held_out and got[i].predicted == int(i < 2000) for i in held)
    assert got[201].predicted == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert {r.predicted for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.toxicity(empty, labels).count() == 0
    assert model.decode("h0use") == "house" and model.decode("r i v e r") == "river"


ENGLISH = """the stupid man was such an idiot and a loser that no one in the house liked him said a friend of the river folk
 who had seen stupid things and idiot deeds by a loser in the past but not so stupid a plan as this one by an idiot of the town"""


def test_obfuscated_spellings(spark):
    plain = spark.createDataFrame([(1, ENGLISH)], "doc_id long, text string")
    model = toxicity.CharModel(toxicity.char_counts(plain))
    seen = lambda text: set(re.findall(r"[a-z]+", toxicity.restore(text, model)))
    for text in ("i d i o t", "i  d  i  o  t", "i/d/i/o/t", "i . d . i . o . t", "iddioott", "1d107", "idi07", "!d!ot!", "such an I*D*I*O*T he", "i|d|i|o|t"):
        assert "idiot" in seen(text), text
    assert "loser" in seen("such a l o s e r") and "stupid" in seen("stu" + "p" * 70 + "id")
    assert {"such", "an", "idiot", "and", "a", "loser"} <= seen("s u c h a n i d i o t a n d a l o s e r")
    scorer = toxicity.Scorer({"stupid": 5.0}, toxicity.ToxicityParams())
    assert scorer.evidence("st up id")[1] == scorer.evidence("a s tupid plan")[1] == 5.0 and scorer.evidence("st up it id")[1] == 0


def brute_repeats(rows, size=200):
    seen = {}
    raw = [(r[1] or "").encode() for r in rows]
    for i, b in enumerate(raw):
        for k in range(len(b) - size + 1):
            seen.setdefault(b[k : k + size], []).append((i, k))
    cover = [bytearray(len(b)) for b in raw]
    for at in seen.values():
        if len(at) > 1:
            for i, k in at:
                cover[i][k : k + size] = b"\1" * size
    out = Counter()
    for r, b, m in zip(rows, raw, cover, strict=True):
        left = bytes(x for x, y in zip(b, m, strict=True) if not y)
        out[r[0], len(b), sum(m), sum(m[k] and (k == 0 or not m[k - 1]) for k in range(len(m))), hashlib.sha256(left).hexdigest()] += 1
    return out


@pytest.mark.parametrize("params", [suffixdedup.SuffixParams(), suffixdedup.SuffixParams(group_rows=2, batch_keys=64, task_anchors=50, task_rows=10)])
def test_long_repeats(docs, rows, params, empty):
    got = suffixdedup.repeats(docs, params).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows)
    assert suffixdedup.repeats(empty, params).count() == 0


def test_index_family():
    import numpy as np

    rng = np.random.default_rng(1)
    family, seen, first = suffixdedup.IndexFamily(), {}, 0
    for size in [5, 40, 3, 200, 1, 77, 300] * 3:
        keys = rng.integers(0, 700, size, dtype=np.uint64)
        numbers = np.arange(first, first + size)
        first += size
        ours, theirs = family.add(keys, numbers)
        got = dict(zip(ours.tolist(), theirs.tolist(), strict=True))
        for k, n in zip(keys.tolist(), numbers.tolist(), strict=True):
            assert got.get(n) == seen.get(k)
            seen.setdefault(k, n)
        sizes = [len(k) for k, _ in family.levels]
        assert sum(sizes) == len(seen) and all(a > b for a, b in zip(sizes, sizes[1:], strict=False))


def test_anchors_do_not_depend_on_the_slice():
    import numpy as np

    rng, p = random.Random(8), suffixdedup.SuffixParams()
    same = bytes(rng.choice(b"ab ") for _ in range(400)) + b"xyz" * 150
    named = []
    for before in (0, 3, 1_000, 70_000):
        text = bytes(rng.choice(b"ab ") for _ in range(before)) + same
        place, key, _ = suffixdedup.anchors(np.frombuffer(text, np.uint8), np.array([0, len(text)]), p)
        named.append({(i - before, k) for i, k in zip(place.tolist(), key.tolist(), strict=True) if i >= before + 200})
    assert named[0] and all(n == named[0] for n in named)


def test_long_repeats_in_texts_of_different_lengths(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(90))
    rows = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([0, 10, 60, 500, 3_000, 30_000])]
    rows = [(i, t[: len(t) // 2] + passage[i * 5 : 300 + i * 9] + t[len(t) // 2 :]) for i, t in rows] + [(9, "ha " * 200), (10, "x" * 199), (11, "x" * 200), (12, "y" * 201), (None, passage), (13, None)]
    got = suffixdedup.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute_repeats(rows)


def test_matches_come_from_the_family(spark, monkeypatch):
    import numpy as np

    from trendloom.llm.suffixdedup import Repeats

    texts = [b"left one " + b"abcdefg hij" * 30, b"other " + b"abcdefg hij" * 30]
    p = suffixdedup.SuffixParams()

    def intervals():
        found = Repeats(p)
        for t in texts:
            raw = np.frombuffer(t, np.uint8)
            place, key, _ = suffixdedup.anchors(raw, np.array([0, len(raw)]), p)
            around = raw[np.clip(place[:, None] + np.arange(-(p.length - p.anchor), p.length), 0, len(raw) - 1)]
            found.add(key, around, np.minimum(p.length - p.anchor, place), np.minimum(p.length, len(raw) - place))
        return len(found.intervals()[0])

    assert intervals() > 0
    monkeypatch.setattr(suffixdedup.IndexFamily, "add", lambda self, keys, numbers: (np.zeros(0, np.int64), np.zeros(0, np.int64)))
    assert intervals() == 0


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    tok.encode_special_tokens = True
    got = packing.pack(docs).collect()
    want = Counter()
    for i, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for n, (start, length) in enumerate(packing.cut(len(ids), 2048)):
            want[i, n, start, length, zlib.crc32(array("I", ids[start : start + length]).tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) == -(-sum(r.length for r in got) // 2048)
    assert packing.pack(empty).count() == 0


def test_packing_of_one_hot_length(spark):
    """Many pieces of one length in very small buckets, so that both steps of the prefix sums count."""
    rows = [(i, "the same words") for i in range(3_000)] + [(5_000 + i, "others here now, " * (i % 3)) for i in range(50)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), packing.PackingParams(bucket_rows=1)).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(got) == len(rows) and len(by) == -(-sum(r.length for r in got) // 2048)
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length


def test_tokens_by_word():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    tok.encode_special_tokens = True
    own, rng = packing.Tokens(packing.default_tokenizer(), 1000), random.Random(5)
    for text in ["", " ", "  a  b", "a\n b", "\n", "a\n", "it's we'll\n'll 12 3a", "<|endoftext|> a", "é è\nñ, ü.", "x\x85 y", "x\x1c y"] + ["".join(rng.choice("ab'sl .,\n\t1é \x1c\x85語") for _ in range(rng.randint(0, 14))) for _ in range(3000)]:
        assert own.ids(text) == array("I", tok.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)


def test_tokens_of_letters():
    """Words of letters skip the pre-tokenizer, whatever the letters; a small cache forgets words but not ids."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    own, rng = packing.Tokens(packing.default_tokenizer(), 100), random.Random(6)
    letters = [c for c in map(chr, range(0x21, 0x1680)) if c.isalpha()]
    full, encode = [], own.words.encode
    own.words.encode = lambda s: full.append(s) or encode(s)
    for c in letters:
        text = f"{c} a{c}b, {c}{c}\n{c}z {rng.choice(letters)}{c}.\n{c}!"
        assert own.ids(text) == array("I", tok.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)
        assert len(own.words.now) + len(own.words.old) <= 120
    assert not full
    for mark in packing._MARKS:
        text = " ".join(f"ab{mark * n} é{mark}c" for n in range(1, 7)) + f"\nab{mark * 4}\n{mark}"
        assert own.ids(text) == array("I", tok.encode(text, add_special_tokens=False).ids).tobytes(), repr(text)
    assert not any(s.startswith(" ab") and len(s) < 8 for s in full)
    full.clear()
    long = "x" * 50
    text = f"{long}, {long}.\n{long} 12&& {long}1"
    assert own.ids(text) == array("I", tok.encode(text, add_special_tokens=False).ids).tobytes()
    assert set(full) == {" 12&&", f" {long}1"}
    assert not any(long in w for w in own.words.now)


def test_mixing(docs, spark, empty, tmp_path):
    import duckdb
    import pyarrow.parquet as pq

    got = mixing.mixture(docs).collect()
    pq.write_table(docs.toArrow(), tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d.parquet'")
    names = ["doc_id", "domain", "language", "src", "n_tokens", "copies"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({mixing.oracle()})").fetchall()
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(want)
    assert mixing.mixture(empty).count() == 0
    picked = mixing.select_documents(docs)
    assert picked.columns == docs.columns and picked.count() == sum(r.copies for r in got)


def test_water_filling(spark):
    leaves = spark.createDataFrame([("d0", "en", "a", 100), ("d0", "en", "b", 1000), ("d0", "de", "c", 1000), ("d1", "en", "e", 10)], "domain string, language string, src string, tokens long")
    p = mixing.MixParams(budget_percent=50, max_epochs=1, domain_weights={}, language_weights={}, source_weights={"a": 9})
    got = {r.src: r.alloc for r in mixing.allocations(leaves, p).collect()}
    # d1 can't take its half of 1055; d0's two languages share the rest, and in en b takes what a can't
    assert got == {"e": 10, "c": 522, "a": 100, "b": 422}


def test_scratch_is_shared_folder(spark, docs):
    from trendloom.llm.common import materialize, scratch_root

    df = materialize(docs.select(F.col("doc_id")), "t")
    assert df.count() == docs.count() and scratch_root(spark).removeprefix("file://") in df.inputFiles()[0]
