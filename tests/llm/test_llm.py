"""The operators on texts: known cases, brute force, round trips, and odd input (nulls, blanks, ties, repeats, no rows, clashing columns)."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lavra.llm import encoding, mixing, packing, personal, scans, sentences, site_lines

PAGES = "page_id long, process string, source string, document_id long, page_number int, text string, header string, footer string, key string, n long, word string, docs long"
SENTENCES = [
    "O perito constatou infiltração na laje do prédio e descreveu o vínculo da obra.",
    "A testemunha declarou que não há dúvida sobre a corrosão da armadura.",
    "O laudo complementar foi juntado aos autos após a complementação dos quesitos.",
    "Verificou-se deformação das vigas no pavimento térreo da edificação.",
]


def pages_df(spark, rows):
    """Rows of (page_id, source, document_id, page_number, text, header, footer), with columns whose names operators use."""
    return spark.createDataFrame([(p, "x", s, d, n, t, h, f, "clash", 7, "clash", 9) for p, s, d, n, t, h, f in rows], PAGES)


def odd_pages(spark):
    return pages_df(spark, [(1, None, None, None, None, None, None), (2, "s", None, None, "", "", ""), (2, "s", None, None, "", "", ""), (3, "s", 1, 1, " \n\n ", "\n", None), (None, "s", 1, 2, "ã?" * 3000, "x" * 20_000, "a-\nb"), (5, "s", 2, 1, "?" * 50, "�", "1")])


def corpus(spark, extra=()):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        body = "\n".join(rng.choice(SENTENCES) for _ in range(6))
        rows.append((i, f"s{i % 2}", i // 2, 1, body, None, None))
    return pages_df(spark, [*rows, *extra])


@pytest.mark.parametrize("f", [
    lambda p: site_lines.repeated_lines(p), lambda p: site_lines.cleaned(p), lambda p: encoding.garbled_lines(p), lambda p: encoding.restored_pages(p),
    lambda p: scans.noise(p), lambda p: scans.repaired(p), lambda p: personal.found(p.select(F.lit("pages").alias("src"), F.col("page_id").alias("row_id"), "text"), personal.lexicon(p.select("text"))),
    lambda p: sentences.sentence_units(p.withColumn("doc_id", F.col("page_id"))),
])
def test_odd_input(spark, f):
    f(odd_pages(spark)).collect()
    f(odd_pages(spark).limit(0)).collect()


# ---- repeated lines


def brute_repeated(rows, min_docs=5, share=0.2):
    docs, holders = defaultdict(set), defaultdict(set)
    for p, s, d, _, *fields in rows:
        if s is None:
            continue
        docs[s].add(d)
        for t in fields:
            for k in site_lines.line_keys(t):
                if k and d is not None:
                    holders[s, k].add(d)
    return Counter((p, name, i) for p, s, d, _, *fields in rows for name, t in zip(site_lines.FIELDS, fields) for i, k in enumerate(site_lines.line_keys(t), 1) if k and len(holders[s, k]) >= min_docs and len(holders[s, k]) >= share * len(docs[s] - {None}))


@pytest.mark.parametrize("counters", [2, 4096])
def test_repeated_lines_like_brute_force(spark, monkeypatch, counters):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        s = rng.choice(["a", "a", "a", "b", None])
        lines = [f"Texto: Núcleo de {s}" if rng.random() < 0.25 else "x", f"TEXTO - nucleo de {s} 12" if rng.random() < 0.1 else f"linha {rng.randrange(50)} única {rng.choice('abcdefgh')}", "1/2"]
        rows.append((i, s, rng.choice([None, *range(60)]), 1, "\n".join(lines), rng.choice([None, "", "Aviso Légal!"]), None))
    rows += rows[:5]
    df = pages_df(spark, rows)
    got = site_lines.repeated_lines(df, counters=counters)
    assert Counter((r.page_id, r.field_name, r.line_no) for r in got.collect()) == brute_repeated(rows)
    drop = {tuple(r) for r in got.select("page_id", "field_name", "line_no").collect()}
    strip = lambda p, f, t: t if t is None else "\n".join(x for i, x in enumerate(t.split("\n"), 1) if (p, f, i) not in drop)
    want = Counter((p, *(strip(p, f, t) for f, t in zip(site_lines.FIELDS, fields))) for p, _, _, _, *fields in rows)
    assert Counter(map(tuple, site_lines.cleaned(df, counters=counters).collect())) == want
    monkeypatch.setattr(site_lines, "bounded", lambda *a, **k: None)
    monkeypatch.setattr(site_lines, "HELD", 10)
    assert Counter(map(tuple, site_lines.cleaned(df, counters=counters).collect())) == want


def test_summary_bounds_counts():
    rng = random.Random(2)
    s, true = site_lines.Summary(20), Counter()
    for i in range(20_000):
        k = str(int(rng.paretovariate(0.6)))
        s.add(k, i)
        true[k] += 1
    s.prune()
    assert all(s.counts.get(k, 0) <= n <= s.counts.get(k, 0) + s.error for k, n in true.items())
    assert s.error <= 20_000 / 20


# ---- wrong decoding


@pytest.mark.parametrize("wrong", [lambda t: t.encode("utf-8").decode("latin-1"), lambda t: t.encode("utf-8").decode("cp850"), lambda t: t.encode("cp1252", "replace").decode("mac_roman"), lambda t: t.encode("utf-8").decode("latin-1").encode("utf-8").decode("latin-1")])
def test_decoding_round_trip(spark, wrong):
    bad = [(1000 + i, "s0", 500 + i, 1, SENTENCES[i % 4] + "\n" + wrong(SENTENCES[(i + 1) % 4]) + "\nsem acento", None, None) for i in range(8)]
    got = {(r.page_id, r.line_no): r.restored for r in encoding.garbled_lines(corpus(spark, bad)).collect()}
    assert got == {(1000 + i, 2): SENTENCES[(i + 1) % 4] for i in range(8)}


def test_lost_characters(spark):
    lost = "".join("?" if not c.isascii() else c for c in SENTENCES[0])
    bad = [(1000 + i, "s0", 500 + i, 1, lost + "\nÉ certo que há dúvida?", None, None) for i in range(6)]
    got = {(r.page_id, r.line_no): r.restored for r in encoding.garbled_lines(corpus(spark, bad)).collect()}
    assert got == {(1000 + i, 1): SENTENCES[0] for i in range(6)}


def test_alignment():
    assert encoding.align("preÃ§o", "preço") == [("Ã§", "ç")]


# ---- scans


def test_automaton_finds_all_like_brute_force():
    rng = random.Random(4)
    vocabulary = {"".join(rng.choice("abcdeirlnmtu") for _ in range(rng.randint(3, 7))) for _ in range(400)}
    trie = scans.Trie()
    for w in vocabulary:
        trie.add(w, 100)
    automaton = scans.Automaton()

    places = lambda w: [(i, a, b) for a, b in scans.CONFUSIONS for i in range(len(w)) if w.startswith(a, i)]
    for w in sorted(vocabulary)[:80]:
        once = places(w)
        for i, a, b in once:
            for j, c, d in [*once, (len(w), "", "")]:
                if j >= i + len(a):  # a second confusion further on, or none
                    read = w[:i] + b + w[i + len(a) : j] + d + w[j + len(c) :]
                    assert read == w or any(x[2] == w for x in automaton.intersect(read, trie, 1))
    assert automaton.intersect("zzz", trie, 1) == []


def test_general_edits_like_brute_force():
    rng = random.Random(6)
    vocabulary = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(4, 6))) for _ in range(150)})
    trie = scans.Trie()
    for w in vocabulary:
        trie.add(w, 100)
    loose = scans.Automaton(confusions=(), most=1.0, general=1.0)

    def edits(w):
        return {w} | {w[:i] + x + w[j:] for i in range(len(w) + 1) for x in ("", *"abcdez") for j in (i, i + 1) if j <= len(w)}

    for w in vocabulary[:40]:
        for read in rng.sample(sorted(edits(w) - {w}), 12):
            assert {v for _, _, v, _ in loose.intersect(read, trie, 1)} == {v for v in vocabulary if v != read and read in edits(v)}


@pytest.mark.parametrize("read, want", [
    ("1.2S4,00", "1.254,00"), ("lO/O3/2024", "10/03/2024"), ("1B,5", "18,5"), ("12OA", "120A"), ("OOSA", "005A"), ("l4h3O", "14h30"), ("lOh", None), ("1234", None), ("SOl", None), ("B12", None), ("", None), ("1-", None),
])
def test_amounts(read, want):
    assert scans.Amounts().printed(read) == want


def test_scan_noise(spark):
    extra = [
        (2000, "s0", 900, 3, "Ana Lima x Banco Real — autos\nO perit0 constatou infiltração na laje do pré-\ndio e rcstou R$ 1.2S4,00.\nVerificou-\nse deformação\nfl. 03", "Ana Lima x Banco Real — autos", None),
        (2001, "s0", 900, 4, "4/9\nO vínculo é 2021.\n2021.", "Ana Lima x Banco Real — autos", "O laudo complernentar"),
    ]
    df = corpus(spark, extra)
    got = {(r.page_id, r.field_name, r.line_no, r.kind) for r in scans.noise(df).where("page_id >= 2000").collect()}
    assert {(2000, "text", 1, "header"), (2000, "text", 2, "misread"), (2000, "text", 2, "hyphen"), (2000, "text", 3, "misread"), (2000, "text", 6, "page_number"), (2001, "text", 1, "page_number"), (2001, "footer", 1, "misread")} == got
    text = scans.repaired(df).where("page_id = 2000").first()["text"]
    assert "O perito constatou infiltração na laje do prédio e" in text and "R$ 1.254,00" in text and "fl. 03" not in text and "autos" not in text and "Verificou-se" in text


@pytest.mark.parametrize("module, f", [
    (scans, lambda p: scans.noise(p)), (site_lines, lambda p: site_lines.repeated_lines(p).select("page_id", "field_name", "line_no")), (encoding, lambda p: encoding.garbled_lines(p).select("page_id", "line_no", "restored")), (encoding, lambda p: encoding.restored_pages(p).withColumn("lost_lines", F.col("lost_lines").cast("string"))),
    (personal, lambda p: personal.found(t := p.select(F.lit("p").alias("src"), F.col("page_id").alias("row_id"), "text"), personal.lexicon(t.select("text")))),
])
def test_models_too_large_to_broadcast(spark, monkeypatch, module, f):
    """What is joined because it is too large to hold gives what a held model gives."""
    wrong = SENTENCES[1].encode("utf-8").decode("latin-1")
    soft = "é certo".encode("utf-8").decode("latin-1") + " perícia" + "\u00ad".encode("utf-8").decode("latin-1")
    extra = [(2000 + i, "s0", 900 + i, 3, f"O perit0 constatou infiltração na laje do pré-\ndio e rcstou. A infil-\ntraçã0\n{wrong}\nVerificou-\nse deformação do guarda-\nchuva, um guarda-chuva\n{soft}\nsem acento", None, "O laudo complernentar") for i in range(4)]
    extra += [(3000 + i, "s1", 990 + i, 1, f"Segundo {a} {b} {c}, vizinha. Falar com {a} {c}.", None, None) for i, (a, b, c) in enumerate((a, b, c) for a in ("Ana", "Rui") for b in ("Lima", "Dias") for c in ("Farias", "Tonigrato"))]
    df = corpus(spark, extra)
    want = Counter(map(tuple, f(df).collect()))
    monkeypatch.setattr(module, "bounded", lambda *a, **k: None)
    assert Counter(map(tuple, f(df).collect())) == want and want


def test_repair_with_models_too_large_to_hold(spark, monkeypatch):
    """Words beside a misread word and counts at divided lines decide also where they are joined."""
    extra = [(1000 + i, "s0", 500 + i, 1, "a casa nova\nda sala bonita\n" * 3, None, None) for i in range(60)]
    extra += [(2000 + i, "s0", 900 + i, 3, f"da {w}a6a bonita\na {w}a6a nova\nO pré-\ndio e in-\nfil-\ntração", None, None) for i, w in enumerate("xyz")]
    extra += [(None, None, None, None, t, None, None) for t in (None, "", "\n", "O perit0 da infil-\ntração")] * 2
    df = corpus(spark, extra)
    misread = [(f"{w}a6a", ["casa", "sala"]) for w in "xyz"]
    monkeypatch.setattr(scans, "misread_words", lambda *a: spark.createDataFrame(misread, "word string, candidates array<string>"))
    want = Counter(map(tuple, scans.repaired(df).collect()))
    assert sum("da sala bonita a casa nova" in (t or "") for _, t in want) == 63  # 60 pages that show it, 3 repaired
    monkeypatch.setattr(scans, "bounded", lambda *a, **k: None)
    for block in (200_000, 2):
        assert Counter(map(tuple, scans.repaired(df, block=block).collect())) == want


# ---- personal information


def test_checksums():
    assert personal.cpf_ok("52998224725") and not personal.cpf_ok("52998224724") and not personal.cpf_ok("11111111111")
    assert personal.luhn_ok("4539578763621486") and not personal.luhn_ok("4539578763621487")
    assert personal.voter_ok("102385010671") and not personal.voter_ok("102385010672") and personal.cnpj_ok("11222333000181") and not personal.cnpj_ok("11222333000182")
    case = "0000001" + "2024" + "8150001"
    dd = f"{98 - int(case + '00') % 97:02d}"
    assert personal.mod97_ok(f"0000001-{dd}.2024.8.15.0001") and not personal.mod97_ok(f"0000001-{(int(dd) + 1) % 97:02d}.2024.8.15.0001")
    finder = personal.Finder(personal.Lexicon(set(), set()))
    assert [k for k, _, _ in finder.find("Ligar para 4539 5787 6362 1486 já")] == [] and [k for k, _, _ in finder.find("CPF nº 529.982.247-25, tel. (11) 91234-5678")] == ["documento", "telefone"]
    assert personal.mod97_ok("GB82 WEST 1234 5698 7654 32") and not personal.mod97_ok("GB82 WEST 1234 5698 7654 33")


def test_personal_information(spark):
    first, last = ["Ana", "Rui", "Márcio", "Inês"], ["Lima", "Dias", "Farias", "Tonigrato", "Petopegu"]
    learn = [f"Dados para crédito: 1, titular {a} {b} {c}. Segundo {a} {c}, vizinha." for a in first for b in last for c in last]
    t = "A perita Inês Farias da Petopegu, CPF 123.456.789-01, reside na Rua das Flores, 12-B e atende em ana.lima@mail.example ou (11) 91234-5678. Protocolo 12345678901. Construtora Lima Dias Ltda. Falar com LIMA, Rui Dias."
    h = "Compareceram M&aacute;rcio Lima Tonigrato e In&ecirc;s Dias<br /> RG n&ordm; 1.234.567 SSP"
    df = spark.createDataFrame([("p", 1, t), ("p", 2, h), ("p", 3, None), *(("q", 10 + i, x) for i, x in enumerate(learn))], "src string, row_id long, text string")
    names = personal.lexicon(df.select("text"))
    got = {(r.row_id, r.kind, r.trecho) for r in personal.found(df, names).where("src = 'p'").collect()}
    assert got == {
        (1, "nome", "Inês Farias da Petopegu"), (1, "documento", "123.456.789-01"), (1, "endereco", "Rua das Flores, 12-B"), (1, "email", "ana.lima@mail.example"), (1, "telefone", "(11) 91234-5678"),
        (1, "nome", "LIMA, Rui Dias"), (2, "nome", "M&aacute;rcio Lima Tonigrato"), (2, "nome", "In&ecirc;s Dias"), (2, "documento", "1.234.567"),
    }
    masked = {r.row_id: r.text for r in personal.masked(df, names).where("src = 'p'").collect()}
    assert masked[2] == "Compareceram [NOME] e [NOME]<br /> RG n&ordm; [DOCUMENTO] SSP" and masked[3] is None


# ---- sentences


@pytest.mark.parametrize("text, want", [
    ("O Sr. Dr. A. Lima mediu 1.234,56 m. Foi em 1.2.2020.Depois saiu.", ["O Sr. Dr. A. Lima mediu 1.234,56 m.", "Foi em 1.2.2020.", "Depois saiu."]),
    ('Ele disse: "Vi. Não li." e saiu. "Nunca!" gritou.', ['Ele disse: "Vi. Não li." e saiu.', '"Nunca!" gritou.']),
    ("I. RELATÓRIO\n \nHouve atraso... mas acabou\nbem. Fim", ["I. RELATÓRIO", "Houve atraso... mas acabou\nbem.", "Fim"]),
    ("Itens:\n- um;\n- dois.\n1. três", ["Itens:", "- um;", "- dois.", "1. três"]),
    ("测得3.47米。“我。没有！”他说。为什么？“从未！”他说。未答复……但结束。", ["测得3.47米。", "“我。没有！”他说。", "为什么？", "“从未！”他说。", "未答复……但结束。"]),
    ("ราคา 45 บาท ศาลอนุญาต ไม่มี", ["ราคา 45 บาท", "ศาลอนุญาต ไม่มี"][:0] or ["ราคา 45 บาท", "ศาลอนุญาต", "ไม่มี"]),
    ("Είναι γνήσια; Ο κ. Νίκος ήρθε.", ["Είναι γνήσια;", "Ο κ. Νίκος ήρθε."]), ("قدم د. ماروش. هل هو؟ نعم.", ["قدم د. ماروش.", "هل هو؟", "نعم."]),
    ("Am 29. Mai kam er. Vgl. S. 14 ff. des Anhangs.", ["Am 29. Mai kam er.", "Vgl. S. 14 ff. des Anhangs."]), ("", []), (" \n ", []), (None, []),
])
def test_units(text, want):
    assert [text[a:b] for a, b in sentences.units(text)] == want


def test_chunks_compose_like_one_run(spark):
    rng = random.Random(9)
    parts = ['Ele disse: "Vi. Fui." e saiu. ', "O Sr. Lima veio. ", "Fim!\n\n", "- item;\n", "“Sim. Não.” disse. ", "测得。“我。没有”说。", "«A. B.» fim. ", "x" * 30 + " ", "... ", " \n \n ", "บาท 45 ศาล "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(30, 90))) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[0]), (None, texts[1]), (50, None), (51, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((i, a, b) for i, t in rows for a, b in sentences.units(t, 10**9))
    for chunk in (1, 7, 300, sentences.CHUNK):
        got = Counter((r.doc_id, r.start_pos, r.end_pos) for r in sentences.sentence_units(df, chunk=chunk).collect())
        assert got == want
    units = Counter((r.doc_id, r.unit) for r in sentences.sentences(df).collect())
    assert units == Counter((i, t[a:b]) for i, t in rows for a, b in sentences.units(t))


def test_a_text_of_five_million_characters():
    one = 'O Sr. Lima veio às 10.30 h. Ele disse: "Vi. Fui." e saiu.\n\n'
    got = sentences.units(one * (5_000_000 // len(one)))
    assert len(got) == 2 * (5_000_000 // len(one)) and got[:2] == sentences.units(one) and got[-1][1] == len(one) * (5_000_000 // len(one)) - 2


def test_prefix_scan_like_a_loop():
    rng = random.Random(1)
    n = len(sentences.STATES)
    fs, first, want, state = [bytes(rng.randrange(n) for _ in range(n)) for _ in range(37)], [i in (0, 5, 6, 20) for i in range(37)], [], 0
    for f, new in zip(fs, first):
        state = 0 if new else state
        want.append(state)
        state = f[state]
    assert sentences.prefix_states(fs, first) == want and sentences.prefix_states([], []) == []


# ---- packing and mixing


def brute_place(levels, size, capacity):
    best, at = (2 * levels[size] + 1 if size < capacity else 0), 0
    for h in range(capacity - size, 0, -1):
        if levels[h]:
            change = 1 - 2 * levels[h] + (2 * levels[h + size] + 1 if h + size < capacity else 0)
            if change < best or change == best and at == 0:
                best, at = change, h
    return at


def test_packing_minimises_squares():
    rng = random.Random(5)
    for capacity in (7, 20, 64):
        sizes = [rng.randint(1, capacity) for _ in range(400)]
        levels, filled = Counter(), Counter()
        for size, box in zip(sizes, packing.pack(sizes, capacity)):
            assert filled[box] == brute_place(levels, size, capacity)
            if filled[box]:
                levels[filled[box]] -= 1
            filled[box] += size
            assert filled[box] <= capacity
            if filled[box] < capacity:
                levels[filled[box]] += 1
    assert packing.pack([], 5) == []


def test_containers(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(SENTENCES) for _ in range(rng.randint(1, 25))) for _ in range(120)] + ["字が多い文章です。" * 200, "क्षत्रिय 😀 ऄ", "", None, texts_repeat := "x y z"]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)] + [(999, texts_repeat, 9)], "doc_id long, text string, capacity int")
    kinds = spark.createDataFrame([(1, 64), (2, 300), (3, None), (4, 0), (5, 1), (6, 5)], "recipiente_id int, capacidade_tokens int")
    rows = packing.containers_of(df, kinds, block=50).collect()
    again = packing.containers_of(df.repartition(7).sortWithinPartitions("text"), kinds, block=50).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    text = dict(enumerate(texts)) | {999: texts_repeat}
    for kind, capacity in ((1, 64), (2, 300), (5, 1), (6, 5)):
        fill, pieces = Counter(), defaultdict(list)
        for r in rows:
            if r.recipiente_id == kind:
                fill[r.container] += r.tokens
                pieces[r.doc_id].append(r)
        assert max(fill.values()) <= capacity
        assert set(pieces) == {i for i, t in text.items() if t}
        for i, ps in pieces.items():
            ps.sort(key=lambda r: r.piece)
            assert "".join(text[i][r.start_pos : r.end_pos] for r in ps) == text[i]
            assert len(ps) == 1 or sum(r.tokens for r in ps) > capacity
        assert sum(fill.values()) / (len(fill) * capacity) > 0.9
    assert packing.containers_of(df.limit(0), kinds).count() == 0


def test_tokens_of_long_white_space():
    from lavra.llm import tokens

    rng = random.Random(2)
    for _ in range(100):
        t = "".join(rng.choice([" ", "\n", " " * rng.randint(500, 700), "\n \t" * 250, "ab", "é.", "1"]) for _ in range(8))
        assert tokens.encode(t) == tokens.encoder().encode_ordinary(t)
    assert len(tokens.encode(" " * 300_000 + "x")) > 1


def test_mixture(spark):
    rng = random.Random(6)
    rows = [(i, "a" if i % 3 else "b", " ".join(rng.choice(SENTENCES) for _ in range(rng.randint(1, 4))) + str(i), 1) for i in range(900)]
    rows += [(1000 + i, "c", "repetido e igual", 1) for i in range(50)] + [(2000 + i, "c", f"outro texto {i} " * 5, 1) for i in range(60)] + [(3000, None, "x", 1), (3001, "a", None, 1), (3002, "a", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, tokens int")
    targets = spark.createDataFrame([(1, "a", 0.3, 2), (1, "b", 0.5, 3), (1, "c", 0.2, 4), (2, "a", 0.5, 1), (2, "none", 0.5, 1), (3, None, 1.0, 1)], "mistura_id int, source string, alvo double, max_repeticoes int")
    used = mixing.mixed(docs, targets, bins=64)
    got = {(r.mistura_id, r.source): r for r in mixing.shares(used, targets).collect()}
    for s, want, cap in (("a", 0.3, 2), ("b", 0.5, 3), ("c", 0.2, 4)):
        assert abs(got[1, s].share - want) < 0.005 and got[1, s].most_copies <= cap
    assert got[2, "a"].share == 1.0 and got[2, "none"].tokens == 0
    one = used.where("mistura_id = 1").collect()
    # nothing that fits what is lacking is left out
    for s in "abc":
        chosen = {r.doc_id: r.copies for r in one if r.source == s}
        assert got[1, s].tokens == sum(r.tokens * r.copies for r in one if r.source == s) and chosen
    assert len({r.doc_id for r in one}) == len(one) and all(r.doc_id < 3000 for r in one)
    assert sorted(map(tuple, one)) == sorted(map(tuple, mixing.mixed(docs, targets, bins=64).where("mistura_id = 1").collect()))
    assert mixing.mixed(docs.limit(0), targets).count() == 0
