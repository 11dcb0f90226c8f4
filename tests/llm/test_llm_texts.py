"""Scorers, tokenisers, decontamination and chat rows against brute force, round trips and held-out labels."""

import random

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, score double, lang_pred string"
SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 1.0, "x") for i, t in rows], DOCS)


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "123 !!"), (None, "plain words"), (5, "twice"), (5, "twice"), (6, "x" * 5000)]


def test_longest_match_lengths(spark):
    from panelforge.llm.tokencount import LongestMatch, count_tokens, vocabulary
    pieces = vocabulary()
    known, automaton, rnd = set(pieces), LongestMatch(pieces), random.Random(3)

    def brute(word):
        s, n, i = "▁" + word, 0, 0
        while i < len(s):
            j = next((j for j in range(min(len(s), i + 20), i, -1) if s[i:j] in known), None)
            if j is None:
                return -1
            n, i = n + 1, j
        return n
    for _ in range(3000):
        word = "".join(rnd.choice("abcdehinorstäß.,!é▁中அ") for _ in range(rnd.randint(1, 15)))
        assert automaton.length(word) == brute(word)
    text = "Ab cd\nஅஆx  ef"
    got = {r.doc_id: r for r in count_tokens(_docs(spark, [*ODD[:4], (9, text)]), pieces).collect()}
    lengths = [brute(w) for w in text.split()]
    assert (got[9].n_words, got[9].n_tokens, got[9].n_unknown) == (
        4, sum(n if n > 0 else 1 for n in lengths), sum(n < 0 for n in lengths))
    assert [got[i].n_tokens for i in (1, 2, 3)] == [0, 0, 0]
    assert count_tokens(_docs(spark, []), pieces).count() == 0


def test_lattice_paths_round_trip_and_public_library(spark):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    from panelforge.llm.pieces import SPACE, Encoder, Pieces, best_path, decode, encode, lattice_paths, round_trip
    from panelforge.llm.tokencount import VOCABULARY
    pieces = Pieces.load()
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(25).collect()]
    words = sorted({w for t in texts for w in t.split()})[:1500] + ["அb", "a" * 30, "😀"]
    units = spark.createDataFrame([(SPACE + w,) for w in words if len(w) < 32], "unit string")
    got = {r.unit: tuple(r.ids) for r in lattice_paths(units, pieces).collect()}
    assert got == {SPACE + w: best_path(SPACE + w, pieces) for w in words if len(w) < 32}
    proto = sentencepiece_model_pb2.ModelProto()  # the public library's Viterbi over the same pieces and scores
    with open(VOCABULARY, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for p in proto.pieces:
        if p.piece in pieces.table:
            p.score = pieces.table[p.piece][1]
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    assert all(list(got[SPACE + w]) == library.encode(w) for w in words if w.isascii() and len(w) < 32)
    encoder = Encoder({}, pieces)
    tricky = ["", " ", "  a  b ", "\n", "a\n", "\na", "x \n y", "中😀 z", "\t tab", "a\r\nb", "y" * 3000, None, "abஅ"]
    assert all(encoder.ids(t).tolist() == library.encode(t) for t in ("a b", "the cat sat") for t in [t])
    df = _docs(spark, list(enumerate(tricky + texts)))
    ids = {r.doc_id: r.piece_ids for r in encode(df, pieces, ["doc_id"], bound=50).collect()}
    back = decode(encode(df, pieces, ["doc_id", "text"], bound=50), pieces, ["doc_id", "text"]).collect()
    assert all(r.decoded == r.text for r in back) and len(back) == len(tricky + texts)
    assert ids == {i: None if t is None else encoder.ids(t).tolist() for i, t in enumerate(tricky + texts)}
    trip = {r.doc_id: r for r in round_trip(df, pieces, bound=50).collect()}
    assert all(trip[i].n_pieces == len(x or ()) and trip[i].exact is (None if x is None else True) for i, x in ids.items())
    assert round_trip(_docs(spark, []), pieces).count() == 0


def test_language_models_are_normalised_and_identify(spark):
    from panelforge.llm.langid import fit, identify, score_batch
    from panelforge.llm.langid import _lookup
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = fit(docs.select("lang", "text"), order=3)
    letters = np.unique(np.concatenate([np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in ("abcdefghijklmnopqrstuvwxyzäöüßéèêçáíñóúàùâîôûëï",)]))
    every = np.concatenate([[0], letters]).astype(np.uint32)
    head = np.tile(np.array([[ord("t"), ord("h")]], np.uint32), (len(every), 1))
    total = np.exp(_lookup(model, np.column_stack([head, every]))).sum(axis=0)
    assert np.all(total < 1.01) and np.all(total > 0.9)
    import pyarrow as pa
    entropy, count = score_batch(model, pa.array(["the and of that", None, "12"]))
    assert count.tolist() == [16, 0, 0] and model.langs[entropy[0].argmin()] == "en"
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    odd = identify(_docs(spark, ODD)).collect()
    assert len(odd) == len(ODD) and all(r.lang_pred == "und" and r.score == 0 for r in odd)
    assert identify(_docs(spark, [])).count() == 0


def test_languages_and_shards_have_no_cap(spark, monkeypatch):
    from panelforge.llm import langid
    rnd = random.Random(5)

    def text(k):  # neighbouring languages share half of their letters
        return " ".join("".join(chr(0x4E00 + 6 * k + rnd.randrange(12)) for _ in range(4)) for _ in range(30))
    rows = [(i, text(i % 70), f"l{i % 70:02d}") for i in range(700)] + [(i, chr(0x3042) * 3, None) for i in range(700, 704)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    whole = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(whole) == 704 and all(whole[i].lang_pred == lang for i, _, lang in rows if lang)
    few = docs.where("doc_id % 70 < 5")
    whole = {r.doc_id: r for r in langid.identify(few).collect()}
    monkeypatch.setattr(langid, "SHARD_LANGUAGES", 2)
    monkeypatch.setattr(langid, "SHARD_CELLS", 2000)
    langs, tables, _ = langid._tables(few, 4)
    assert len(langid._plan(tables, langs)) > 6
    cut = {r.doc_id: r for r in langid.identify(few).collect()}
    assert set(cut) == set(whole)
    for i, r in cut.items():
        assert (r.lang_pred, r.rejected) == (whole[i].lang_pred, whole[i].rejected)
        assert r.cross_entropy == pytest.approx(whole[i].cross_entropy, abs=1e-5)


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_lexicon_matches_edit_distance():
    from panelforge.llm.toxicity import EDIT_FACTOR, FuzzyLexicon, edits_allowed
    rnd = random.Random(8)
    terms = {"".join(rnd.choice("abc") for _ in range(n)): 1.0 + n / 10 for n in (3, 4, 5, 6, 7, 9, 10, 11, 12)}
    lexicon = FuzzyLexicon(terms)
    for _ in range(4000):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 13)))
        if rnd.random() < 0.7:
            word = list(rnd.choice(list(terms)))
            for _ in range(rnd.randint(0, 3)):
                k = rnd.randrange(len(word) + 1)
                word[k:k + rnd.randint(0, 1)] = rnd.choice(["", "d", "a"])
            word = "".join(word)
        want = max((w * EDIT_FACTOR ** _distance(word, t) for t, w in terms.items()
                    if _distance(word, t) <= edits_allowed(t)), default=0.0)
        want = terms.get(word, want)
        assert lexicon.match(word)[0] == pytest.approx(want), word


def test_toxicity_on_held_out_labels_and_quotes(spark):
    from panelforge.llm.toxicity import Model, drop_toxic, features, fit, score_documents
    from panelforge.llm.toxicity import FuzzyLexicon, _Matches
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    got = score_documents(docs, model).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) >= 0.93 * len(got)
    kept = drop_toxic(docs, model)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    matches = _Matches(FuzzyLexicon({"moron": 5.0}))
    plain, quoted = features("he is a moron today", matches), features('someone said "moron" today', matches)
    assert plain[0] > quoted[0] > 0 and quoted[2] > 0 == plain[2]
    assert features("a m0ron and a morron", matches)[3] == 2
    odd = score_documents(_docs(spark, ODD), Model({}, frozenset(), -1.0, (0.0, 0.0, 0.0))).collect()
    assert len(odd) == len(ODD) and {r.predicted for r in odd} == {0}
    none = fit(_docs(spark, ODD), labels.limit(0))
    assert none.terms == {} and score_documents(_docs(spark, []), none).count() == 0


def test_misspellings_with_signs_short_terms_and_look_alikes(spark):
    from panelforge.llm.toxicity import FuzzyLexicon, _Matches, features, fit
    matches = _Matches(FuzzyLexicon({"bastard": 5.0, "moron": 5.0, "dumb": 4.0}))

    def hits(text):
        return features(text, matches)[3]
    assert hits("b@$tard") == hits("what a ba$t@rd he is") == hits("see moron@example.org") == hits("@moron") == 1
    assert hits("a dunb idea") == 0 and hits("you are dunb") == 1 and hits("a dunb moron") == 2 and hits("a dumb idea") == 1
    import zlib
    rnd, first = random.Random(6), [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 0]
    # zorgblatt: in five toxic rows and a clean one, too few for a term; zorgblot: in a clean row only
    extra = dict.fromkeys(range(200), "zorgblat") | dict.fromkeys(first[:5], "zorgblatt") | {first[-1]: "zorgblatt", first[-2]: "zorgblot"}
    words = [f"word{chr(97 + k)}" for k in range(12)]
    docs = _docs(spark, [(i, " ".join(rnd.choices(words, k=30) + [extra.get(i, "")])) for i in range(900)])
    model = fit(docs, spark.createDataFrame([(i, int(i < 200)) for i in range(900)], "doc_id long, toxic int"))
    assert set(model.terms) == {"zorgblat"} and model.harmless == {"zorgblot"}


def test_quotations_reach_along_the_line():
    from panelforge.llm.toxicity import FuzzyLexicon, _Matches, features
    matches, far = _Matches(FuzzyLexicon({"moron": 5.0})), "so it went on and on " * 20

    def quoted(text):
        return features(text, matches)[2] > 0
    assert quoted(f'he told "{far} moron {far}" again') and quoted(f"er rief „{far} moron {far}“ laut")
    closed = '"' + far[:180] + '"' + far[:100]  # 200 characters before the word lie inside the closed quotation
    assert not quoted(f'{closed} moron "yes"') and not quoted(f'a 5" pipe, a moron and a 6" pipe')
    assert not quoted('"open\nmoron" closed') and not quoted('"left open, moron') and quoted(f'"moron" {far}')
    assert quoted("word " * 70_000 + '"a moron"') and not quoted("word " * 70_000 + '"a" moron "b"')


def test_rare_strong_terms_are_learned(spark, monkeypatch):
    from panelforge.llm import toxicity
    monkeypatch.setattr(toxicity, "LEXICON_TERMS", 5, raising=False)  # a cap by frequency has no effect
    rnd = random.Random(4)
    common = [f"word{chr(97 + k)}" for k in range(12)]
    rows = [(i, " ".join(rnd.choices(common, k=30)) + (" zorgblat" if i < 60 else "")) for i in range(800)]
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(800)], "doc_id long, toxic int")
    assert set(toxicity.fit(_docs(spark, rows), labels).terms) == {"zorgblat"}


def test_quality_keeps_clean_documents(spark):
    from panelforge.llm.quality import LABELLERS, accuracies, drop_rejected, fit, score_documents, votes
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs)
    got = score_documents(docs, model).join(labels, "doc_id").collect()
    clean, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert sum(r.accepted for r in clean) >= 0.99 * len(clean) and sum(not r.accepted for r in bad) >= 0.8 * len(bad)
    assert drop_rejected(docs, model).columns == docs.columns
    odd = {r.doc_id: r for r in score_documents(_docs(spark, ODD), model).collect()}
    assert [odd[i].accepted for i in (1, 2, 3)] == [False] * 3 and odd[1].votes == "2" * len(LABELLERS)
    good = "1" * len(LABELLERS)  # two kinds of junk, each of which trips two labellers
    _, table, posterior = accuracies({good: 900, "00" + good[2:]: 60, good[:-2] + "00": 40})
    assert posterior[good] > 0.9 and posterior["00" + good[2:]] < 0.1 > posterior[good[:-2] + "00"] and table[1, 1] > 0.9
    assert votes("spam " * 400)[0] == "0"
    empty = _docs(spark, [])
    assert score_documents(empty, fit(empty)).count() == 0


def test_templates_find_changed_parameters(spark):
    from panelforge.llm.decontaminate import contaminated, document_report, drop_contaminated
    item = "A train leaves the old station with 120 people and Anna gives 7 tickets to Boris before the trip starts again at 9 km"
    plain = "whoever reads these lines knows that nothing in them was ever about numbers or anyone else at all"
    bench = spark.createDataFrame([(1, item, 5), (2, plain, 6), (3, None, 7), (4, "", 8), (None, plain, 9)],
                                  "item_id long, text string, doc_id long")
    again = item.replace("120", "98").replace("Anna", "Clara").replace("Boris", "Dmitri").replace(" 7 ", " 3 ").replace("9 km", "4 miles")
    mixed = again + ". " + again.replace("Clara", "Elena").replace("98", "51").replace("3 tickets", "8 tickets").replace(
        "Dmitri", "Farid") + ". " + again.replace("Clara", "Gustav").replace("98", "2").replace("3 tickets", "77 tickets").replace("Dmitri", "Hana")
    rows = [(10, "Before. " + item + " After."), (11, "Well, " + again), (12, mixed), (13, plain.upper()), (14, "clean text " * 30),
            (15, "whoever reads these lines knows"), (16, None), (17, ""), (None, item), (18, item), (18, item)]
    docs = _docs(spark, rows)
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, bench).collect()}
    assert set(got) == {(10, 1), (11, 1), (13, 2), (18, 1)}
    assert got[(10, 1)].consistency == 1 and got[(11, 1)].consistency == 1
    report = {r.doc_id: r.contaminated for r in document_report(docs, bench).collect()}
    assert len(report) == 10 and [k for k, v in report.items() if v] and not report[12] and not report[None]
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 12, 14, 15, 16, 17]
    assert drop_contaminated(docs, bench.limit(0)).count() == len(rows)
    assert document_report(_docs(spark, []), bench).count() == 0


def test_decontamination_judges_regions(spark):
    from panelforge.llm.decontaminate import contaminated
    item = "A train leaves the old station with 120 people and Anna gives 7 tickets to Boris before the trip starts again at 9 km"
    other = item.replace("120", "98").replace("Anna", "Clara").replace("Boris", "Dmitri").replace(" 7 ", " 3 ").replace("9 km", "4 miles")
    third = item.replace("120", "51").replace("Anna", "Elena").replace("Boris", "Farid").replace(" 7 ", " 8 ").replace("9 km", "6 miles")
    gap, words = " nothing to see here" * 60, item.split()
    scattered = gap.join(" ".join(words[i: i + 5]) for i in range(0, len(words) - 4, 2))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = _docs(spark, [(1, item + ". " + other), (2, other + gap + " . " + third), (3, scattered), (4, item[:60] + gap),
                         (5, item + ". " + other + ". " + third), (6, gap + " . " + other)])
    got = {r.doc_id: r for r in contaminated(docs, bench).collect()}
    assert set(got) == {1, 2, 5, 6} and all(r.consistency == 1 and r.windows <= 20 for r in got.values())


def test_decontamination_keeps_dense_and_short_windows(spark):
    from panelforge.llm.decontaminate import contaminated
    dense = "we saw grey owls near 4 5 6 7 8 9 10 11 12 13 14 15"
    bench = spark.createDataFrame([(1, "12 + 7 * 3 = ?"), (2, dense), (3, "blue whales sing"), (4, "sum of 3 4 5 and 6 7 8 is 33")],
                                  "item_id long, text string")
    gap = " nothing to see here" * 20
    docs = _docs(spark, [(1, gap + " 12 + 7 * 3 = ?" + gap), (2, gap + " 13 + 7 * 3 = ?" + gap), (3, gap + " " + dense + gap),
                         (4, "we saw grey owls near 9 houses" + gap), (5, gap + " blue whales sing" + gap), (6, "Blue whales sing"),
                         (7, gap + " whales sing blue" + gap), (8, gap + " sum of 8 9 1 and 2 3 4 is 27" + gap),
                         (9, gap + " sum of 3 4 5 and 6 7 8 is 33"), (10, gap + " we hear blue whales sing")])
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert got == {(1, 1), (3, 2), (5, 3), (6, 3), (8, 4), (9, 4), (10, 3)}


def test_items_that_differ_in_values_only_are_judged_as_one_class(spark):
    from panelforge.llm.decontaminate import contaminated, document_report, drop_contaminated

    def question(a, b, c, again):
        return f"a shed with {a} old doors and {b} new windows was sold for {c} coins by the man who built {again} more sheds last spring"
    items = [(k, question(k, 100 + k, 200 + k, k)) for k in range(30)] + [(40 + k, question(k, 100 + k, 200 + k, 300 + k)) for k in range(5)]
    items += [(None, question(1, 2, 3, 4)), (60, None), (61, "")]
    gap = " " + "plain words between both texts go on and on " * 12
    texts = [question(901, 902, 903, 901),  # follows the pattern of the first 30, and of the others as well
             question(901, 902, 903, 904),  # breaks the first pattern in one slot of several
             question(3, 103, 203, 3), question(901, 902, 903, 901) + gap + question(2, 102, 202, 302), gap, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as class", "2 as members", "3 as item_id")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as class", "'x' as pattern", "0 as h")
    rows = contaminated(docs, bench).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, set()).add(r.item_id)
    first, other = set(range(30)), set(range(40, 45))
    assert got[0] == first | other and got[2] == first | other and got[3] == first | other
    assert other <= got[1] and 4 not in got and 5 not in got
    report = {r.doc_id: (r.contaminated, r.n_items) for r in document_report(docs, bench).collect()}
    assert report == {i: (i in got, len(got.get(i, ()))) for i in range(6)}
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4, 5}
    assert contaminated(docs, bench.limit(0)).count() == 0 and contaminated(docs.limit(0), bench).count() == 0


def test_preference_rows(spark):
    from panelforge.llm.chat import preference_rows, turns_of, with_weaker_reply
    pairs = [("chosen", 0, "user", "hi"), ("rejected", 0, "user", "hi"), ("chosen", 1, "assistant", "yes"),
             ("rejected", 1, "assistant", "no!"), ("chosen", 2, "user", "ok"), ("chosen", 2, "user", "ok")]
    df = spark.createDataFrame([(1, *p) for p in pairs] + [(2, "chosen", 0, "user", "same"), (2, "rejected", 0, "user", "same"),
                                                           (None, "chosen", 0, "user", "x"), (3, None, 0, "user", "x")],
                               "pair_id long, side string, turn long, role string, text string")
    got = {r.pair_id: r for r in preference_rows(df).collect()}
    assert set(got) == {1, 2} and got[1].prompt == "<|im_start|>user\nhi<|im_end|>\n" and got[1].prompt_turns == 1
    for text, spans, want in ((got[1].chosen, got[1].chosen_spans, "yes"), (got[1].rejected, got[1].rejected_spans, "no!")):
        assert [text[s.start:s.end] for s in spans] == [want + "<|im_end|>"]
    assert got[1].chosen.endswith("user\nok<|im_end|>\n") and got[2].chosen == got[2].rejected == ""
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a b c d"), (1, 1, "assistant", "a b c d"), (1, 2, "user", "bye"),
             (2, 0, None, None), (None, 0, "user", "x"), (3, None, "assistant", "w x")]
    rows = turns_of(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    made = {r.pair_id: r for r in preference_rows(with_weaker_reply(rows)).collect()}
    assert set(made) == {1, 2, 3} and "bye" not in made[1].chosen and "a b c d" in made[1].chosen
    assert "a b<|im_end|>" in made[1].rejected and made[2].prompt_turns == 1
    long = spark.createDataFrame([(1, s, t, "assistant" if t % 2 else "user", f"t{t}{s if t > 90 else ''}")
                                  for t in range(200) for s in ("chosen", "rejected")],
                                 "pair_id long, side string, turn long, role string, text string")
    parts = {r.part: r for r in preference_rows(long).collect()}
    assert sorted(parts) == [0, 1, 2, 3] and parts[0].prompt_turns == 64 and parts[1].prompt_turns == 27 and parts[2].prompt == ""
    assert preference_rows(long.limit(0)).count() == 0


def test_preference_rows_go_by_order_not_by_number(spark):
    from panelforge.llm.chat import preference_rows
    turns = [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "b")]
    rows = [(1, "chosen", n, *t) for n, t in enumerate(turns)] + [(1, "rejected", 7 + 3 * n, *t) for n, t in enumerate(turns[:3])]
    rows += [(1, "rejected", 90, "assistant", "worse")]
    rows += [(2, "chosen", n, *t) for n, t in enumerate(turns)] + [(2, "rejected", n - 5, *t) for n, t in enumerate(turns)]
    rows += [(3, "chosen", 0, *turns[0]), (4, "rejected", None, None, None), (4, "chosen", 0, "", "")]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    clash = df.selectExpr("*", "1 as place", "'x' as part", "0 as c", "1 as split", "2 as _range", "3 as at")
    got = {r.pair_id: r for r in preference_rows(clash.repartition(3)).collect()}
    assert set(got) == {1, 2, 3, 4} and got[1].prompt_turns == 3 and got[1].preference
    assert got[1].prompt == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns[:3])
    assert "b<|im_end|>" in got[1].chosen and "worse<|im_end|>" in got[1].rejected
    assert got[2].prompt_turns == 4 and not got[2].preference and got[2].chosen == got[2].rejected == ""
    assert got[3].preference and got[3].rejected == "" and got[3].prompt == "" and "q" in got[3].chosen
    assert not got[4].preference and got[4].prompt_turns == 1


def test_last_stage_decodes_what_it_encodes(spark):
    import corpus_pipeline as P
    from panelforge.llm.pieces import SPACE
    rows = [(1, "plain  words\nஅ😀 "), (2, ""), (3, None), (4, f"a{SPACE}b")]
    got = {r.doc_id: r for r in P.STAGES[-1][1](spark, _docs(spark, rows), SF001).collect()}
    assert [got[i].exact for i in (1, 2, 3, 4)] == [True, True, None, False] and got[3].n_pieces == 0 < got[1].n_pieces


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as P
    from panelforge.llm.decontaminate import contaminated
    from panelforge.llm.minhash import near_duplicates
    from panelforge.llm.pieces import Encoder, Pieces
    documents = spark.read.parquet(f"{SF001}/documents.parquet")
    docs = documents
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, SF001).cache()
        assert docs.columns == documents.columns and 0 < docs.count() <= before.count(), name
        assert docs.select("doc_id").subtract(before.select("doc_id")).count() == 0
    assert contaminated(docs, spark.read.parquet(f"{SF001}/benchmark.parquet")).count() == 0
    assert near_duplicates(docs, 5).where("not kept").count() == 0
    encoder = Encoder({}, Pieces.load())
    want = {r.doc_id: encoder.ids(r.text).tolist() for r in docs.collect()}
    got = {r.doc_id: r.piece_ids for r in P.run(spark, SF001).collect()}
    assert got == want


def test_letters_of_all_planes():
    from panelforge.llm.langid import letters
    assert (letters("\U00030000\U00030001\U000323AF") != 0).sum() == 3
    assert (letters("12 \U0001F600 !") != 0).sum() == 0


def test_distinct_words_beyond_what_is_remembered():
    from panelforge.llm.quality import Distinct
    exact, spread = Distinct(1000), Distinct(1000)
    for i in range(0, 50_000, 500):
        exact.add([f"w{j % 900}" for j in range(i, i + 500)])
        spread.add([f"word{j}" for j in range(i, i + 500)] * 2)
    assert len(exact) == 900 and len(spread.words) <= 1000
    assert abs(len(spread) - 50_000) < 0.15 * 50_000


def test_sample_takes_rows_without_ids_like_others(spark):
    from panelforge.llm.quality import SAMPLE, sampled
    rows = spark.range(22_000).selectExpr("if(id < 10000, null, id) as doc_id", "concat('text ', id) as text")
    got = sampled(rows, 22_000).collect()
    without = sum(int(r.text.split()[1]) < 10_000 for r in got)
    assert 0.9 * SAMPLE < len(got) < 1.1 * SAMPLE and 0.4 < without / len(got) < 0.51
    assert sorted(got) == sorted(sampled(rows.repartition(7), 22_000).collect())
    same = spark.range(9000).selectExpr("cast(null as long) as doc_id", "'one' as text")
    assert sampled(same, 9000).count() <= 2 * SAMPLE
