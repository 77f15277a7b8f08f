"""Operators that are trained or that rewrite texts: held-out accuracy, round trips and the defined cases."""

import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import DOCS, table

import corpus_pipeline
from palisade.llm import language, main_text, neighbours, packing, surrogates, toxicity
from palisade.llm.common import prepare_arrow
from palisade.session import prepare


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    prepare_arrow(prepare(spark))


BAD = ["grubnik", "fozzard", "wimblet", "snarkel"]
LABELS = {"doc_id": "long", "quality": "int", "toxic": "int"}


def labelled(n, seed=1, plain=None):
    rng = random.Random(seed)
    plain = plain or ["".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    texts, labels = [], []
    for k in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 300))]
        if k % 4 == 0:
            for _ in range(1 + len(words) // 30):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        texts.append(" ".join(words))
        labels.append(int(k % 4 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    texts, labels = labelled(400)
    return toxicity.fit(texts, labels, 0.25)


def test_toxicity_held_out(model):
    texts, labels = labelled(120, seed=2)
    found = [model.score(t) >= toxicity.THRESHOLD for t in texts]
    assert np.mean([f == bool(y) for f, y in zip(found, labels, strict=True)]) > 0.95


def test_operating_point_holds_at_every_sample():
    """Clean documents stay, toxic ones go, whatever sample the model saw; documents of 20 to 2000 words."""
    rng = random.Random(8)
    plain = ["".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    texts, labels = labelled(400, seed=9, plain=plain)
    texts = [" ".join([t] * (1 + 7 * (k % 3 == 0))) for k, t in enumerate(texts)]
    kept = []
    for size, seed in ((200, 11), (400, 12), (400, 13), (1600, 14)):
        own = toxicity.fit(*labelled(size, seed=seed, plain=plain), 0.25)
        found = np.array([own.score(t) >= toxicity.THRESHOLD for t in texts])
        toxic = np.array(labels) == 1
        assert (~found[~toxic]).mean() >= 0.95 and found[toxic].mean() >= 0.9
        assert min(own.combine[:2]) >= 0
        kept.append((~found).mean())
    assert max(kept) - min(kept) <= 0.03


def test_logistic_fit_converges():
    """Also where the unguarded Newton step jumps: separable data, few documents, unequal weights."""
    rng = np.random.default_rng(5)
    for scale in (0.1, 1, 30):
        x = np.column_stack([rng.normal(size=200) * scale, rng.normal(size=200) * scale, np.ones(200)])
        for y in ((x[:, 0] > 0), (x[:, 0] + x[:, 1] + scale * rng.normal(size=200) > scale), np.arange(200) < 3):
            weight = np.where(y, 0.2, 2.0)
            beta = toxicity.logistic(x, y.astype(float), weight)
            q = 1 / (1 + np.exp(-x @ beta))
            slope = x.T @ (weight * (q - y)) + 1e-3 * weight.sum() * np.array([*beta[:2], 0])
            assert np.abs(slope).max() < 1e-3 * weight.sum() * max(1, scale)


def test_scores_equal_a_plain_scorer(model, corpus):
    odd = ["É ÉCOLE ß İstanbul", "a", "  ", "Ａｂｃ 漢字 の text", "x" * 3000, "snarkel. " * 40 + "fine words here " * 60]
    for text in [t for _, t in corpus if t is None or len(t) < 6000] + odd:
        assert abs(model.score(text) - brute.toxicity_score(model, text)) < 1e-4


def test_misspellings_share_their_ngrams(model):
    clean = labelled(1, seed=3)[0][0].split()[:20]
    odds = lambda w: model.window_odds(" ".join([*clean, w])).max()
    assert min(odds("grubnikk"), odds("snarkels")) > odds("abilone") + 0.5
    assert model.score("x " * 5000 + " ".join(BAD * 20) + " y" * 5000) > model.score("x " * 10_000)


def test_toxicity_cases(spark, docs, corpus, no_docs):
    labels = table(spark, LABELS, [(d, None, d % 2) for d in range(20)] + [(0, 1, None), (0, 1, 1), (None, 1, 1), (999, 0, 1)])
    found = toxicity.toxicity(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = found.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in corpus)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and brute.held_out(r["doc_id"])) for r in got)
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert all(r["score"] < 1e-6 for r in toxicity.toxicity(docs, table(spark, LABELS, [])).collect())


def test_labels_of_held_out_rows_are_never_learned(spark, docs):
    base = [(d, None, int(d % 3 == 0)) for d in range(60)]
    turned = [(d, q, 1 - t if brute.held_out(d) else t) for d, q, t in base]
    one, two = (sorted(tuple(r) for r in toxicity.toxicity(docs.where("doc_id is not null"), table(spark, LABELS, rows)).collect()) for rows in (base, turned))
    assert one == two


def test_language(spark, no_docs):
    rng = random.Random(7)
    sounds = {"aa": "ka lo mi nu ta", "bb": "sch ung keit pf ei", "cc": "éa òu ñi çe"}
    say = lambda lang, n: " ".join("".join(rng.choice(sounds[lang].split()) for _ in range(rng.randint(1, 4))) for _ in range(n))
    rows = [(k, say(lang, rng.randint(3, 120)), lang, None, None) for k, lang in enumerate(list(sounds) * 80)]
    odd = [(1000, None, "aa", None, None), (1001, "", "bb", None, None), (1002, "12 ?! 3", "cc", None, None), (1003, say("bb", 20), None, None, None),
           (None, say("cc", 9000), "aa", None, None), (1004, "λόγος 漢字", None, None, None), (1003, say("bb", 20), None, None, None)]
    found = language.languages(table(spark, DOCS, rows + odd)).collect()
    assert len(found) == len(rows) + len(odd)
    lang = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert all(lang[k] == ("und", 0.0) for k in (1000, 1001, 1002))
    assert lang[1003][0] == "bb" and lang[None][0] == "cc" and lang[1004][0] in sounds
    held = [r for r in found if r["held_out"] and r["doc_id"] < 1000]
    assert np.mean([r["lang_pred"] == list(sounds)[r["doc_id"] % 3] for r in held]) > 0.95
    assert language.languages(no_docs).count() == 0
    alone = language.languages(table(spark, DOCS, [(1, "some text", None, None, None)])).collect()
    assert [(r["lang_pred"], r["score"]) for r in alone] == [("und", 0.0)]


def test_texts_without_letters_have_no_language(spark):
    rows = [(k, "some words of one language", "aa", None, None) for k in range(40)] + [(100 + k, "andere woerter hier", "bb", None, None) for k in range(40)]
    odd = ["²", "½ ①", "Ⅷ ⑳", "5 € §", "ª", "中"]
    found = language.languages(table(spark, DOCS, rows + [(500 + k, t, None, None, None) for k, t in enumerate(odd)]))
    got = {r["doc_id"]: r["lang_pred"] for r in found.collect()}
    assert [got[500 + k] == "und" for k in range(len(odd))] == [True, True, True, True, False, False]


def test_network_tables_equal_the_convolution():
    net = language.fit(["ab cd " * 60, "xy zz " * 50], ["p", "q"], epochs=1)
    rows = language.windows(language.text_bytes("abc xyz " * 100))
    inside = net.embed[rows]
    pooled = [sum(inside[:, j : j + language.WINDOW - len(f) + 1] @ f[j] for j in range(len(f))).max(axis=1) for f in net.filters]
    logits = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0) @ net.out + net.out_bias
    expected = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    assert np.allclose(net.log_odds(rows, net.tables()), expected, atol=1e-4)


PAGES = {"page_id": "long", "url": "string", "html": "string"}
FURNITURE = ['<nav><a href="/x">Menu</a></nav>', '<div class="ad">Buy</div>', "<footer>&copy; foot</footer>", '<div class="cookie-notice">ok?</div>',
             "<form>go<input></form>", "<script>var t='</p>';</script>", "<style>p{}</style>", '<aside>side</aside>', "<!-- <p>no</p> -->",
             '<div id="sidebar-left"><p>left</p></div>', '<section class="comments"><p>first!</p></section>']


def test_main_text(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for k in range(60):
        body = [f"Para {k}.{j} &amp;amp; text<br>goes \n on &eacute;<b>bold</b>" for j in range(rng.randint(2, 6))]
        expected[k] = " ".join(["Head"] + [f"Para {k}.{j} &amp; text goes on ébold" for j in range(len(body))])
        box = ("<article>", "</article>") if k % 3 else (f'<div class="post-{k} entry">', "</div>")
        rest = rng.sample(FURNITURE, 5)
        rows.append((k, f"http://h{k % 3}.example/{k}", "".join(
            ["<html><body>", *rest[:3], box[0], "<h1>Head</h1>", *(f"<p>{b}" for b in body), rest[3], box[1], rest[4]])))
    odd = {100: None, 101: "", 102: "<", 103: "<p>un<b>closed", 104: "plain & text", 105: "</div></p>" * 5000, 106: "<div>" * 3000 + "deep"}
    expected |= {100: "", 101: "", 102: "<", 103: "unclosed", 104: "plain & text", 105: "", 106: "deep"}
    rows += [(k, None, h) for k, h in odd.items()] + [(0, "http://h0.example/0", rows[0][2])]
    found = main_text.main_texts(table(spark, PAGES, rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert len(got) == len(rows)
    assert {r["page_id"]: r["text"] for r in got} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert main_text.main_texts(table(spark, PAGES, [])).count() == 0


def test_host_consensus_decides(spark):
    """A page whose own best container is a quote box follows its host."""
    page = lambda main, box: f'<body><div class="story">{main}</div><div class="story"><div class="q">{box}</div></div></body>'
    rows = [(k, "http://h.example/a", page("<p>long story text here</p>", "")) for k in range(5)]
    rows.append((9, "http://h.example/b", page("<p>story</p>", "<p>box of words</p>")))
    text = {r["page_id"]: r["text"] for r in main_text.main_texts(table(spark, PAGES, rows)).collect()}
    assert text[9] == "story box of words" and text[0] == "long story text here"


@pytest.mark.parametrize("names", ['class="content-sidebar-wrap"', 'class="has-sidebar"', 'id="header-fixed"', 'class="post social-science"'])
def test_wrappers_named_like_furniture_keep_the_article(names):
    text = "Head " + "words of the article " * 20
    side = '<div class="sidebar">left out</div><nav>menu</nav>'
    for box in ("<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', "{}"):
        page = f"<body>{side}<div {names}>{box.format(f'<p>{text}</p>')}</div><p>foot line</p></body>"
        assert main_text.extracted(page, []).startswith(text.strip()) and "left out" not in main_text.extracted(page, [])
    inner = f"<article><h1>T</h1><div {names}><p>{text}</p></div></article>"
    assert main_text.extracted(f"<body>{side}{inner}</body>", []) == "T " + text.strip()
    replies = '<div class="comments">' + "<p>so they say</p>" * 90 + "</div>"
    assert main_text.extracted(f"<body><article><p>{text}</p></article>{replies}</body>", []) == text.strip()


def test_consensus_drops_nothing_of_the_page_and_holds_for_every_template(spark):
    page = lambda main, more: f'<body><div class="wrap"><div class="content"><p>{main}</p></div>{more}</div></body>'
    main, more = "first half " * 11, "other half " * 9
    rows = [(k, "http://h.example/a", page("whole article " * 9, "")) for k in range(9)]
    rows.append((9, "http://h.example/b", page(main, f'<div class="details"><p>{more}</p></div>')))
    links = '<div class="details"><a href="/x">to another page</a></div>'
    rows.append((10, "http://h.example/c", page(main, links)))
    # Twelve templates of one host; the last one's pages hold more text beside the container that its host agrees on.
    story = "<p>" + "the story " * 10 + "</p>"
    rows += [(100 + 10 * t + k, "http://t.example/", f'<body><div class="t{"abcdefghijkl"[t]}">{story}</div></body>') for t in range(12) for k in range(14 - t)]
    box = "<p>" + "a quote box " * 10 + "</p>"
    rows.append((500, "http://t.example/l", f'<body><nav>{"menu " * 90}</nav><div class="tl">{story}</div><div class="q">{box}</div></body>'))
    text = {r["page_id"]: r["text"] for r in main_text.main_texts(table(spark, PAGES, rows)).collect()}
    assert text[0] == ("whole article " * 9).strip() and text[9] == f"{main}{more}".strip() and text[10] == main.strip()
    assert text[500] == ("the story " * 10 + "a quote box " * 10).strip()


def test_paths_of_different_containers_differ():
    """However deep the page is: the outer steps are hashed, not cut."""
    page = main_text.parse("".join(f'<div class="{a}"><div class="w">' * 1 + "<div>" * 18 + "text" + "</div>" * 20 for a in ("left", "right")))
    assert len(page.paths) == 41 and len(set(page.paths)) == len(page.paths)
    assert max(len(p.split(">")) for p in page.paths) <= main_text.PATH_STEPS
    again = main_text.parse('<div class="left"><div class="w">' + "<div>" * 18 + "other" + "</div>" * 20)
    assert set(again.paths) <= set(page.paths)


def test_formulas_stay():
    page = ('<body><nav>menu</nav><article><p>Let <math><mi>x</mi><annotation encoding="TeX">\\x</annotation></math> be <math><mn>4</mn></math>.</p>'
            "<form>send</form></article></body>")
    assert main_text.extracted(page, []) == "Let x be 4."


def test_page_of_suspects_only_is_not_empty():
    page = '<body><nav>menu</nav><div class="sidebar">one two</div><div class="menu">three</div><div id="share">four five</div></body>'
    assert main_text.extracted(page, []) == "one two three four five"


PERSONAL = ("Mail Bob.Lee@Mail7.example.com or bob.lee@mail7.example.com, +1 (017) 555-7713 or +1 017 555 7713, 97.51.17.173, 4111 1111 1111 1111, "
            "4111111111111111, DE89 3704 0044 0532 0130 00, 123-45-6789. Mr. David Miller met Mary Stone. Later Miller left. Госпожа Анна Петрова.")


def test_surrogates_keep_kind_format_and_coreference():
    new, found = surrogates.rewritten(PERSONAL, "k", {})
    assert [k for _, _, k in found] == ["email", "email", "phone", "phone", "ip", "card", "card", "iban", "ssn", "first", "name", "first", "name",
                                        "name", "first", "name"]
    assert all(PERSONAL[a:b] not in new for a, b, _ in found)
    again = surrogates.detected(new)
    parts = [new[a:b] for a, b, _ in again]
    assert [k for _, _, k in again] == [k for _, _, k in found]
    assert parts[0].lower() == parts[1] and parts[0][0].isupper() and parts[0].endswith(".com")
    assert re.sub(r"\D", "", parts[2]) == re.sub(r"\D", "", parts[3]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", parts[2])
    digits = parts[5].replace(" ", "")
    assert digits == parts[6] and surrogates._luhn(digits[:-1]) == int(digits[-1])
    iban = parts[7].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert surrogates.GENDER_OF[parts[9]] == ("m", "latin") and surrogates.GENDER_OF[parts[11]] == ("f", "latin")
    assert surrogates.GENDER_OF[parts[14]] == ("f", "cyrillic") and re.fullmatch("[А-ЯЁ][а-яё]+", parts[15])
    assert parts[10] == parts[13] != parts[12]
    assert surrogates.rewritten(PERSONAL, "other key", {})[0] != new
    clean = "Version 3.0.1 of 2024-01-15 costs 10.000.000 and 23904 x. The and attion to thanedble the, anea."
    assert surrogates.rewritten(clean, "k", {}) == (clean, [])


@pytest.mark.parametrize(("number", "code"), [("+49 30 1234567", "+49"), ("+44 20 7946 0958", "+44"), ("+420 221 111 222", "+420"), ("+1 (017) 555-7713", "+1"),
                                              ("+7 495 123 45 67", "+7")])
def test_phones_keep_their_country(number, code):
    for key in "abcdef":
        new, found = surrogates.rewritten(f"Call {number}!", key, {})
        assert [k for _, _, k in found] == ["phone"]
        assert new.startswith(f"Call {code} ") and new != f"Call {number}!" and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", f"Call {number}!")


@pytest.mark.parametrize("name", ["McDonald", "O'Brien", "O’Neill", "Wałęsa", "Dvořák", "Παπαδόπουλος", "王伟", "MacArthur-Łoś"])
def test_names_of_any_letters_behind_a_title(name):
    text = f"We met Dr {name} and then {name}'s friend."
    new, found = surrogates.rewritten(text, "k", {})
    assert [text[a:b] for a, b, _ in found] == [name, name] and name not in new and new.count(new[found[0][0] : found[0][1]]) == 2


def test_first_names_are_gathered_over_the_corpus(spark):
    texts = ["Then Emily Johnson spoke.", "Mrs Emily Clark and Mr Tadeusz Nowak", "Yesterday Tadeusz McKay came with Mary Stone", "Dr Quinn Vance",
             "Quinn Harper", "Emma Harper is unknown"]
    rows = {r["doc_id"]: r for r in surrogates.replaced(table(spark, DOCS, [(k, t, None, None, None) for k, t in enumerate(texts)]), key="k").collect()}
    found = {k: [(kind, texts[k][int(a) : int(b)]) for kind, a, b in (e.split(":") for e in r["entities"].split(",") if e)] for k, r in rows.items()}
    assert found[0] == [("first", "Emily"), ("name", "Johnson")] and found[4] == [("name", "Quinn"), ("name", "Harper")] and found[5] == []
    assert found[2] == [("first", "Tadeusz"), ("name", "McKay"), ("first", "Mary"), ("name", "Stone")]
    women, men = ({*surrogates.FIRST_NAMES[g, "latin"], n} for g, n in (("f", "Emily"), ("m", "Tadeusz")))
    emily, tadeusz = rows[0]["text"].split()[1], rows[2]["text"].split()[1]
    assert emily in women - {"Emily"} and tadeusz in men - {"Tadeusz"} and rows[1]["text"].split()[1] == emily


def test_permutation_is_one_to_one():
    sizes = [3, 10, 2, 5]
    every = [[a, b, c, d] for a in range(3) for b in range(10) for c in range(2) for d in range(5)]
    assert sorted(surrogates.permuted(e, sizes, "k", "t") for e in every) == every


def test_collisions_are_settled(spark, monkeypatch):
    plain = surrogates.surrogate
    monkeypatch.setattr(surrogates, "KEY", "k")
    entities = spark.createDataFrame([("iban", f"DE{n:02d}370400440532013000") for n in range(40)] + [("name", "A"), ("ssn", "1")], "kind string, canon string")
    odd = {(r["kind"], r["canon"]): r["attempt"] for r in surrogates.exceptions(entities, "k").collect()}
    new = [(r["kind"], plain(r["kind"], r["canon"], "k", odd.get((r["kind"], r["canon"]), 0))) for r in entities.collect()]
    assert len(set(new)) == len(new) and len([k for k in odd if k[0] == "iban"]) == 39


def test_replaced(spark, docs, corpus, no_docs):
    both = table(spark, DOCS, [(1, PERSONAL, None, None, None), (2, "IBAN DE11 3704 0044 0532 0130 00", None, "s", 3), (3, None, None, None, None), (4, "", None, None, None),
                               (1, PERSONAL, None, None, None)])
    found = surrogates.replaced(both, key="k")
    assert set(both.columns) <= set(found.columns)
    got = found.collect()
    assert Counter((r["doc_id"], r["n_entities"]) for r in got) == Counter({(1, 16): 2, (2, 1): 1, (3, 0): 1, (4, 0): 1})
    ibans = {re.search(r"[A-Z]{2}\d\d(?: \d{4})+ \d\d", r["text"])[0] for r in got if r["n_entities"]}
    assert len(ibans) == 2
    assert {r["doc_id"]: r["text"] for r in got if not r["n_entities"]} == {3: None, 4: ""}
    left = Counter((r["doc_id"], r["text"]) for r in surrogates.replaced(docs.select("doc_id", "text")).collect())
    assert left == Counter((d, t if t is None else surrogates.rewritten(t, surrogates.KEY, {})[0]) for d, t in corpus)
    assert surrogates.replaced(no_docs).count() == 0


def test_recall_of_learned_partitions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    net = neighbours.fit(x[:2000])
    part = net.parts(x, 1)[:, 0]
    sent = net.parts(x[::20], neighbours.PROBES)
    s = x[::20] @ x.T
    s[np.arange(200), np.arange(0, 4000, 20)] = -9
    best = np.argsort(-s, axis=1)[:, :20]
    assert np.mean([part[c] in sent[q] for q in range(200) for c in best[q]]) >= 0.9
    label = neighbours.balanced_parts(x[:2000], neighbours.neighbour_graph(x[:2000]), 16)
    assert np.bincount(label).max() <= 1.05 * 2000 / 16 + 1


def test_pipeline_stages(spark, sf_dir):
    """Every stage against the brute-force answer on its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        after = docs.collect()
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        old = {r["doc_id"]: r["text"] for r in before}
        kept[name] = ids = {r["doc_id"] for r in after}
        if name == "toxicity":
            known = [d for d in old if d in labels]
            assert np.mean([(d in ids) == (labels[d] == 0) for d in known]) > 0.8
        elif name == "near_dedup":
            assert ids == {d for d, _, c in brute.near_rows(list(old.items()), 5) if c == d}
        elif name == "decontaminate":
            assert ids == {r[0] for r in brute.contamination_rows(list(old.items()), items) if not r[-1]}
        else:
            assert {r["doc_id"]: r["text"] for r in after} == {d: surrogates.rewritten(t, surrogates.KEY, {})[0] for d, t in old.items()}
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] != old[r["doc_id"]])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == ids
    by = Counter()
    for r in packed:
        by[r["sequence_id"]] += r["length"]
    assert max(by.values()) <= packing.CAPACITY
    cache = packing.WordCache()
    whole = {r["doc_id"]: zlib.crc32(cache.whole(r["text"] or "") + bytes(4)) for r in docs.collect()}
    assert all(whole[r["doc_id"]] == r["ids_crc32"] for r in packed if Counter(p["doc_id"] for p in packed)[r["doc_id"]] == 1)
