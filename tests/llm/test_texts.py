import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import encode, garbled, leaks, subjects

NASTY = ["", " ", "\n\n  \t", "a", "don't we'll I'M", "<|endoftext|> x", "naïve café", "日本語のテキスト。" * 50, "a b  c   d", "🙂👩‍👩‍👧", "x" * 5000, "1234 5 67890", "wörd " * 4000, " lead", "trail ", "a\r\nb"]


def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    import os

    path = os.path.join(os.path.dirname(encode.RANKS), "byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("text", NASTY)
def test_ids_are_those_of_the_public_tokenizer(text):
    ids = encode.encode_text(text)
    assert ids == tokenizer().encode(text, add_special_tokens=False).ids
    assert encode.decode_ids(ids) == text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab '’\n\t 1²é語.,!  ​🙂Ⅷ")), max_size=60), st.integers(1, 6))
def test_cuts_are_safe(text, size):
    parts = list(encode.pieces(text, size))
    assert "".join(parts) == text
    enc = encode.encoding()
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_texts_without_spaces_are_cut():
    text = "日本語の文章です。それで、２３" * 15000
    parts = list(encode.pieces(text))
    assert len(parts) > 10 and max(map(len, parts)) < 2 * encode.PIECE
    assert encode.encode_text(text) == encode.encoding().encode_ordinary(text)


def test_encode_table(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "hello world", 3), (3, "hello world", 3), (4, "w " * 20000, 4)]
    got = [(r.doc_id, list(r.ids)) for r in encode.encode(spark.createDataFrame(rows, "doc_id long, text string, ids int")).collect()]
    assert sorted((k, len(v)) for k, v in got) == [(1, 0), (2, 0), (3, 2), (3, 2), (4, 20001)]
    assert encode.encode(spark.createDataFrame([], "doc_id int, text string")).count() == 0


PASSAGES = [
    "In 1790 the village of Griostnor bought the sunken pier beside the river Gonmar for 104 crowns. The ledger lists 249 looms, 44 ovens and one windowless kiln. Letters sent out of Rinyor in 1806 mention a sunken bell.",
    "In 1612 the guild of Harlin sold the thatched barn beside the river Kesmon for 88 crowns. The ledger lists 310 looms, 12 ovens and one draughty kiln. Letters sent out of Wendov in 1702 mention a narrow bell.",
    "A surveyor named Fallin counted 590 steps from the weighhouse of Semqua down to Rinpel. Travellers from Olmar wrote that the tin of Fenbel smelled of cork. Old maps place Taldun north of Vikrin.",
]


@pytest.fixture(scope="module")
def index():
    return leaks.Index([(1, PASSAGES[0]), (2, PASSAGES[1]), (3, PASSAGES[2]), (4, PASSAGES[0]), (5, None), (6, ""), (7, "Only Marquandel knows the Brifentol.")])


def found(index, text):
    return [case[0] for case in index.leaks(text)]


def test_leaks(index):
    s = leaks.sentences(PASSAGES[0])
    filler = "It does what it says. Love it! The seam held up quietly after 12 washes. " * 30
    assert sorted(found(index, filler + PASSAGES[0] + filler)) == [1, 4]
    assert sorted(found(index, f"x {s[1]} {s[2]} y")) == [1, 4]
    assert found(index, f"x {s[0]} y {filler} {s[2]}") == []  # not neighbouring
    assert found(index, s[1]) == [] and found(index, "") == [] and found(index, None) == [] and found(index, "  \n") == []
    assert found(index, "In 1888 the village of Unknown bought the sunken pier beside the river Other for 7 crowns. The ledger lists 1 looms, 2 ovens and one windowless kiln.") == []
    assert found(index, "only marquandel knows the brifentol") == [7]


def test_altered_leaks(index):
    p = leaks.sentences(PASSAGES[2])
    two = f"{p[0]} {p[1]}"
    for changed in (two.upper(), two.lower().replace(".", ""), two.replace("e", "е").replace("o", "о"), "​".join(two), f"<p>{p[0]}</p><p>{p[1]}</p>", two.replace("the ", ""), two.replace(" ", "\n"), two.replace("Fallin", "Fallinn").replace("Olmar", "Omlar"), two.replace(" of ", " really of ")):
        assert found(index, changed) == [3], changed


def test_wand_finds_all_above_threshold(index):
    """Against scoring every unit."""
    rnd = random.Random(1)
    words = sorted({w for u in index.words for w in u})
    for _ in range(300):
        q = set(rnd.sample(words, rnd.randint(1, 25)))
        for t in (0.5, 1.0):
            full = []
            for u in range(len(index.words)):
                score = sum(p.impacts[p.units.index(u)] for w in q if u in (p := index.postings[w]).units)
                if score >= t + 1e-9:
                    full.append(u)
            assert set(full) <= set(index.search(q, t))


def test_nothing_is_lost_before_verification(index):
    """Sentences thinned, padded and repeated at random: all that verification accepts pass the screen and the search."""
    rnd = random.Random(5)
    long_one = " ".join(f"w{i % 70} of" for i in range(150)) + "."
    index = leaks.Index([(1, PASSAGES[0]), (2, PASSAGES[1]), (3, PASSAGES[2]), (8, long_one), (9, "The ledger of the ledger of the guild lists the ledger. One kiln is one kiln.")])
    accepted = 0
    for _ in range(1500):
        u = rnd.randrange(len(index.words))
        keep = rnd.uniform(0.4, 1)
        seq = [w for w in index.words[u] if rnd.random() < keep]
        for _ in range(rnd.randrange(len(seq) + 3)):
            seq.insert(rnd.randrange(len(seq) + 1), rnd.choice(["filler", "the", "of", "quite"]))
        seq = ["x"] * rnd.randrange(200) + seq + ["y"] * rnd.randrange(200)
        if index.counts(u, seq):
            accepted += 1
            step = index.window // 2
            assert any(u in index.search(set(seq[lo : lo + index.window])) for lo in range(0, max(1, len(seq) - step), step))
            assert any(u in index.signed[w] for w in set(seq) if w in index.signed)
    assert accepted > 300


def test_long_sentence_and_markup():
    """A sentence of 150 words is found whole or with a fifth of its words missing; a tag of any length is no text."""
    passage = " ".join(f"word{i}" for i in range(150))
    index = leaks.Index([(1, passage)])
    assert found(index, "a b c " * 200 + passage + " d e f" * 200) == [1]
    assert found(index, " ".join(w for i, w in enumerate(passage.split()) if i % 5)) == [1]
    assert found(index, f"<p class='{passage}'>short</p>") == [] and leaks.words("a <b and c> d 1<2 e") == ["a", "d", "1", "2", "e"]


def test_question_and_answer_are_reported():
    index = leaks.Index([(1, PASSAGES[0], "Which bell was sunken?", "Rinyor"), (2, PASSAGES[1], None, None)])
    assert index.leaks(PASSAGES[0]) == [(1, 3, 0.5, 1.0)] and index.leaks(PASSAGES[1]) == [(2, 3, 0.0, 0.0)]


@pytest.mark.parametrize("block", [20_000, 1, 2])
def test_leaked_table(spark, monkeypatch, block):
    """Any number of blocks gives the same cases."""
    monkeypatch.setattr(leaks, "BLOCK", block)
    docs = spark.createDataFrame([(1, PASSAGES[0], 9), (1, PASSAGES[0], 9), (2, None, 9), (3, "", 9), (5, PASSAGES[2].replace("Fallin", "Falin"), 9)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(1, PASSAGES[0]), (3, PASSAGES[2]), (4, PASSAGES[0])], "item_id long, passage string")
    assert sorted((r.doc_id, r.item_id) for r in leaks.leaked(docs, items).collect()) == [(1, 1), (1, 4), (5, 3)]
    assert leaks.leaked(docs, items.where("false")).count() == 0


TERMS = {"music": ["the cello bow", "jazz chords", "a minor scale", "the brass section", "vibrato", "the metronome"], "law": ["the plaintiff", "case law", "a tenancy clause", "the notary", "an affidavit", "the appeal court"],
         "sport": ["the relay baton", "goal kicks", "a half marathon", "shin guards", "breaststroke", "the velodrome"], "cooking": ["puff pastry", "a roux", "the stock pot", "marinades", "knife skills", "poached eggs"]}
FRAMES = ["It helped me with {} at once.", "Before this I never understood {}.", "Good for {} so far.", "We tried it during {} last month.", "Skip to {} now.", "Since {} came up I marked pages."]
PLAIN = ["Total waste of money.", "Love it so much.", "The seam held up quietly.", "Ordered some of them in green.", "My sister is thrilled.", "Delivery took days."]


def corpus(n, seed, hide=()):
    rnd, out = random.Random(seed), []
    for i in range(n):
        names = rnd.sample(sorted(TERMS), rnd.choice([0, 1, 1, 1, 2]))
        ss = [rnd.choice(FRAMES).format(rnd.choice([t for t in TERMS[s] if t not in hide])) for s in names for _ in range(rnd.randint(2, 4))]
        ss += [rnd.choice(PLAIN) for _ in range(rnd.randint(1, 4))]
        if rnd.random() < 0.3:
            other = rnd.choice([s for s in TERMS if s not in names] or ["music"])
            if other not in names:
                ss.append(f"Opening the box was harder than {rnd.choice(TERMS[other])}.")
        rnd.shuffle(ss)
        out.append((i, " ".join(ss), set(names)))
    return out


def test_subjects(spark):
    """Held-out accuracy, with a third of the wordings missing from the samples."""
    samples = [(i, t, "en", s) for i, t, names in corpus(200, 1, hide=("vibrato", "the metronome", "an affidavit", "the appeal court")) for s in (names or {None})]
    docs = corpus(700, 2)
    df = spark.createDataFrame([(i, t, "shop", 1) for i, t, _ in docs] + [(9001, None, None, 1), (9002, "", None, 1), (9003, " \n", None, 1), (9004, "Good for vibrato so far.", None, 1)], "doc_id long, text string, source string, subject_name int")
    subs = spark.createDataFrame([(1, "music"), (2, "law"), (3, "sport"), (4, "cooking"), (4, "cooking")], "subject_id int, subject_name string")
    sam = spark.createDataFrame(samples, "sample_id long, sample_text string, lang string, subject_name string")
    got = [(r.doc_id, r.subject_name) for r in subjects.assign(df, subs, sam).collect()]
    want = {(i, s) for i, _, names in docs for s in names}
    assert len(got) == len(set(got))
    tp = len(want & set(got))
    assert tp / len(got) > 0.95 and tp / len(want) > 0.95
    assert all(i < 9000 for i, _ in got)
    bare = {(r.doc_id, r.subject_name) for r in subjects.assign(df.select("doc_id", "text"), subs, sam).collect()}
    assert len(bare & want) / len(want) > 0.95  # neither source nor item
    assert subjects.assign(df.where("false"), subs, sam).count() == 0


def test_two_sentences():
    p = np.array([[0.9, 0.5], [0.8, 0.5]])
    assert np.allclose(subjects.at_least_two(p), [0.72, 0.25])
    word, how, section = np.array([0, 3, 9]), np.array([0, 5, 3]), np.array([3, 0, 2])
    assert all((x == y).all() for x, y in zip(subjects.decode_votes(subjects.encode_votes(word, how, section, 10), 10), (word, how, section)))


def test_chunks_by_hand():
    """Features once per sentence; a document of very many sentences goes another way to the same result."""
    docs = [subjects.tokens("One two one. Two one!"), subjects.tokens("")]
    c = subjects.Chunk.of(docs)
    one, two = subjects.word_id("one"), subjects.word_id("two")
    assert c.n == 2 and c.n_docs == 2 and c.doc.tolist() == [0, 0]
    assert sorted(c.s[c.f == one].tolist()) == [0, 1] and sorted(c.s[c.f == two].tolist()) == [0, 1] and len(c.f) == 7
    rnd = np.random.default_rng(1)
    f, s = rnd.integers(0, 50, 3000), rnd.integers(0, 40, 3000)
    assert all((x == y).all() for x, y in zip(subjects._unique_pairs(f, s, 40), subjects._unique_pairs(f, s, 1 << 16)))


def test_languages_from_samples():
    samples = [(subjects.tokens(t), set(), g) for g, t in [("en", "the box is fine."), ("de", "der Kasten ist gut.")] * 6]
    marks = subjects.language_marks(samples)
    assert marks[2] == 2
    c = subjects.Chunk.of([subjects.tokens("The cat. Quux."), subjects.tokens("Quux."), subjects.tokens("Der Hund.")])
    assert subjects.languages(c, marks).tolist() == [1, 1, 2, 0]


def test_dominated_sources(spark):
    rows = [("a", [1, 1])] * 12 + [("b", [1, 2])] * 12 + [("c", [3])] * 2 + [(None, [1])] * 20
    df = spark.createDataFrame(rows, "source string, classes array<int>")
    assert [tuple(r) for r in subjects.dominated(df, "source").collect()] == [("a", 1), ("b", 1)]


WORDS = "été forêt élève année niño señal año mañana Küche schöne größer Straße город книга новости погода школа журнал yağmur güneş çiçek değil".split()


def texts(n, seed):
    rnd = random.Random(seed)
    return [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(2, 4))) for _ in range(n)]


CASES = [("utf-8", "cp1252"), ("utf-8", "cp437"), ("cp1251", "koi8-r"), ("utf-8", "cp1251")]


def test_garbled(spark):
    clean = texts(3000, 1)
    rows, want = [("f", i, -1, None if i % 7 == 0 else f"s{i % 5}", t) for i, t in enumerate(clean)], {}
    k = len(rows)
    for n, t in enumerate(texts(80, 2)):
        a, b = CASES[n % len(CASES)]
        try:
            bad = t.encode(a).decode(b)
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
        if bad != t:
            want[k] = t
            rows.append(("f", k, -1, f"s{n % 5}", bad))
            k += 1
    extra = [("", None), ("plain ascii", None), (None, None), ("gr�n b�t", 1), ("été " * 500, None), ("Â table ÃO", None)]
    for t, bad in extra:
        if bad:
            want[k] = None
        rows.append(("f", k, -1, "s1", t))
        k += 1
    df = spark.createDataFrame(rows + rows[-3:-2], "field_name string, row_id long, list_pos int, source string, text string")
    df = df.where("text is not null")
    got = garbled.garbled_rows(df).collect()
    ids = {r.row_id for r in got}
    assert len(ids & want.keys()) >= 0.95 * len(want) and len(ids - want.keys()) <= 0.05 * len(want)
    fixed = {r.row_id: r.fixed for r in got}
    right = [i for i, t in want.items() if t is not None]
    assert sum(fixed.get(i) == want[i] for i in right) >= 0.9 * len(right)
    assert sum(1 for r in got if r.row_id == k - len(extra) + 3) == 2  # the repeated row is named twice
    assert garbled.garbled_rows(df.where("false")).count() == 0


def test_a_hot_garbled_text_is_found(spark):
    """One garbled anchor of a hot page fills a third of the rows, from one source or from many."""
    schema = "field_name string, row_id long, list_pos int, source string, text string"
    clean = [("f", i, -1, f"s{i % 50}", t) for i, t in enumerate(texts(3000, 1) + ["Bücher Zubehör"] * 20)]
    bad = "Bücher Zubehör".encode().decode("cp1252")
    for sources in (1, 50):
        hot = [("f", 10_000 + i, -1, f"s{i % sources}", bad) for i in range(1500)]
        got = garbled.garbled_rows(spark.createDataFrame(clean + hot, schema)).collect()
        assert {r.row_id for r in got} == {r[1] for r in hot} and {r.fixed for r in got} == {"Bücher Zubehör"}, sources


def test_weak_cases_of_a_garbled_source(spark):
    """Texts whose gain alone is too small are garbled in a source that is garbled throughout, and only there."""
    schema = "field_name string, row_id long, list_pos int, source string, text string"
    clean = [("f", i, -1, f"s{i % 50}", t) for i, t in enumerate(texts(3000, 1))]
    weak = [(20_000 + 2 * i + j, f"{t} {i}") for i in range(30) for j, t in enumerate(("année", "größer"))]  # gains of 2.7 here
    rows = [("f", i, -1, "bad", t.encode().decode("cp1252")) for i, t in weak]
    got = {r.row_id: r.fixed for r in garbled.garbled_rows(spark.createDataFrame(clean + rows, schema)).collect()}
    assert got == dict(weak)


def test_long_text_is_repaired_whole(spark):
    """Gains of several hundred still tell a whole repair from half a one, in a source that has many of the half kind."""
    schema = "field_name string, row_id long, list_pos int, source string, text string"
    clean = [("f", i, -1, f"s{i % 50}", t) for i, t in enumerate(texts(2000, 1) + ["Schöne größere Küche für Straße"] * 50)]
    half = [("f", 10_000 + i, -1, "s1", f"{t} {i}".encode().decode("latin-1")) for i, t in enumerate(texts(40, 3))]
    long_one = " ".join(f"Schöne größere Küche für die Straße {i}." for i in range(60))
    df = spark.createDataFrame([*clean, *half, ("f", 1_000_000, -1, "s1", long_one.encode().decode("cp1252"))], schema)
    assert {r.row_id: r.fixed for r in garbled.garbled_rows(df).collect()}[1_000_000] == long_one


def rows_moved(spark):
    """Rows that all stages so far have written for shuffles."""
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return {(s := stages.apply(i)).stageId(): s.shuffleWriteRecords() for i in range(stages.size())}


def garbled_sources():
    """Texts of 300 sources, of which one is large and one garbled throughout."""
    clean = [("f", i, -1, f"s{i % 300}" if i % 3 else "large", f"{t} {i}") for i, t in enumerate(texts(3000, 1))]
    bad = [garbled.garble(f"{t} {i}", garbled.CHAINS[2]) for i, t in enumerate(texts(200, 2))]
    return clean + [("f", 10_000 + i, -1, f"s{i % 7}" if i % 2 else "bad", t) for i, t in enumerate(bad) if t]


def test_rounds_move_no_cases(spark, monkeypatch):
    """Where nothing is small enough for a broadcast, a further round of EM shuffles sums only."""
    df = spark.createDataFrame(garbled_sources(), "field_name string, row_id long, list_pos int, source string, text string").select("field_name", "source", "text")
    odd = df.where(df.text.rlike("[^\\x00-\\x7f]")).localCheckpoint()
    monkeypatch.setattr(garbled, "if_small", lambda x, *_: x)
    monkeypatch.setattr(garbled, "STILL", 0.0)
    before, took = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rounds in (1, 4):
            monkeypatch.setattr(garbled, "ROUNDS", rounds)
            old = rows_moved(spark)
            garbled.posteriors(odd, df.where("false"))
            took.append(sum(n for k, n in rows_moved(spark).items() if k not in old))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert (took[1] - took[0]) / 3 < odd.count() / 4, took


def test_sources_in_several_parts(spark, monkeypatch):
    """Large sources dealt to several tasks give what they give in one."""
    df = spark.createDataFrame(garbled_sources(), "field_name string, row_id long, list_pos int, source string, text string")
    got = []
    for part in (30_000, 40):
        monkeypatch.setattr(garbled, "PART", part)
        got.append(sorted(garbled.garbled_rows(df).collect()))
    assert got[0] == got[1] and len(got[0]) > 150


#: Words that each written encoding can hold.
SCRIPTS = {
    "latin": WORDS[:13] + ["Zubehör", "garçon", "crème", "Übung", "Äpfel"], "turkish": ["yağmur", "güneş", "çiçek", "değil", "Şişli"], "central": ["žluťoučký", "kůň", "příliš", "łódź", "źródło", "święto"],
    "baltic": ["šaltibarščiai", "ąžuolas", "žąsis", "ūkis"], "cyrillic": ["город", "книга", "новости", "погода", "школа", "журнал"], "greek": ["καλημέρα", "Ελλάδα", "βιβλίο", "θάλασσα"],
    "japanese": ["日本語", "新しい本", "東京都", "天気予報"], "chinese": ["中文", "新闻", "天气", "学校"], "korean": ["한국어", "날씨", "학교", "신문"], "traditional": ["中文", "新聞", "學校", "天氣"],
}
WAYS = [c for c in garbled.CHAINS if c]


@pytest.mark.parametrize("chain", WAYS, ids=[" ".join("-".join(x) for x in c) for c in WAYS])
def test_chains_undo(chain):
    """Every chain has words that it garbles without loss, and gives them back."""
    took = 0
    for w in [w for ws in SCRIPTS.values() for w in ws]:
        bad = garbled.garble(w, chain)
        if bad is not None and bad != w:
            took += 1
            assert garbled.undo(bad, chain) == w
    assert took


def test_repairs_by_chain():
    """Texts of two to four words in all scripts, each garbled by every chain that can take it: the repair of the best gain is the text in most cases."""
    rnd, by_script = random.Random(4), {}
    for name, ws in SCRIPTS.items():
        by_script[name] = [" ".join(rnd.choice(ws) for _ in range(rnd.randint(2, 4))) for _ in range(300)]
    clean = [t for ts in by_script.values() for t in ts]
    scorer = garbled.Scorer(garbled.TextModel(garbled.count_text(clean, [1] * len(clean))))
    right = total = 0
    for chain in WAYS:
        for ts in by_script.values():
            for t in ts[:12]:
                bad = garbled.garble(t, chain)
                if bad is None or bad == t:
                    continue
                total += 1
                found = scorer.score(bad, 0)
                right += bool(found) and max(found, key=lambda x: x[1])[2] == t
    assert total > 500 and right > 0.95 * total, (right, total)
