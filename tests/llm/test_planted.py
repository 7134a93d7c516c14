"""Cases planted in made-up rows: what an operator finds is held against them, with precision and recall asserted."""

import random

from lavra.llm import canonical, encoding, mixing, names, packing, personal, scans, sentences, site_lines, vocabulary

WORDS = "perito vistoria imóvel parede laudo processo quesito honorários perícia documento assinatura contrato terreno medição fundação infiltração relatório sentença despacho intimação audiência testemunha avaliação engenharia estrutura cobertura telhado corrosão armadura concreto".split()


def score(found, planted):
    both = len(found & planted)
    return both / max(1, len(found)), both / max(1, len(planted))


def sentence(rng, n=9):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, source string, document_id long, page_number int, text string, header string, footer string")


def test_scan_noise(spark):
    rng = random.Random(11)
    rows, planted = [], set()
    for p in range(600):
        lines = [sentence(rng) for _ in range(8)]
        if p % 3 == 0:
            i = rng.randrange(8)
            w = rng.choice([x for x in lines[i].split() if "o" in x[1:-1] and len(x) > 6] or ["x"])
            if w != "x":
                k = w.index("o", 1)
                lines[i] = lines[i].replace(w, w[:k] + "0" + w[k + 1 :], 1)
                planted.add((p, "text", i + 1, "misread"))
        if p % 4 == 0:
            w = rng.choice([x for x in WORDS if len(x) > 8])
            lines[5] = f"{lines[5]} {w[:4]}-"
            lines[6] = f"{w[4:]} {lines[6]}"
            planted.add((p, "text", 6, "hyphen"))
        lines.append(f"fl. {p % 7 + 1}")
        planted.add((p, "text", 9, "page_number"))
        rows.append((p, f"s{p % 3}", p // 5, p % 7 + 1, "\n".join(lines), None, None))
    found = {tuple(r) for r in scans.noise(pages(spark, rows)).select("page_id", "field_name", "line_no", "kind").collect()}
    precision, recall = score(found, planted)
    assert precision >= 0.99 and recall >= 0.99


def test_personal_values(spark):
    rng = random.Random(12)
    given, family = ["Ana", "Rui", "Inês", "Márcio", "Débora", "Hélio"], ["Tramontele", "Dupagafa", "Petopegu", "Bisemonli", "Gucrucono", "Lalumelo", "Farias", "Dantas"]
    rows, planted = [], set()
    for i in range(400):
        name = f"{rng.choice(given)} {rng.choice(family)} {rng.choice(family)}"
        cpf = f"{rng.randrange(10**3):03d}.{rng.randrange(10**3):03d}.{rng.randrange(10**3):03d}-{rng.randrange(100):02d}"
        mail, phone, place = f"a{i}@correio.example", f"({rng.randrange(11, 99)}) 9{rng.randrange(1000, 9999)}-{rng.randrange(1000, 9999)}", f"Rua das Flores, {rng.randrange(1, 900)}"
        rows.append(("p", i, f"Perito {name}, CPF {cpf}, telefone {phone}, residente na {place}. Escrever para {mail} sobre o protocolo {rng.randrange(10**10, 10**11)} de R$ 1.234,56."))
        planted |= {(i, "nome", name), (i, "documento", cpf), (i, "email", mail), (i, "telefone", phone), (i, "endereco", place)}
    df = spark.createDataFrame(rows, "src string, row_id long, text string")
    found = {(r.row_id, r.kind, r.trecho) for r in personal.found(df, personal.lexicon(df.select("text"))).collect()}
    precision, recall = score(found, planted)
    assert precision >= 0.99 and recall >= 0.99


def mistyped(rng, w):
    i = rng.randrange(1, len(w) - 1)
    return rng.choice([w[:i] + w[i + 1 :], w[: i - 1] + w[i] + w[i - 1] + w[i + 1 :], w[:i] + w[i] + w[i:], w[:i] + rng.choice("aeiost") + w[i + 1 :]])


def test_typed_values(spark):
    rng = random.Random(13)
    listed = ["Engenharia Civil", "Engenharia Elétrica", "Contabilidade", "Psicologia", "Grafotécnica", "Topografia", "Odontologia", "Fisioterapia", "Informática", "Geologia"]
    ref = spark.createDataFrame([(f"E{i}", "G", n) for i, n in enumerate(listed)], "canon_id string, grupo string, nome string")
    rows, want = [], {}
    for i in range(600):
        k = rng.randrange(len(listed))
        ws = listed[k].split()
        ws[-1] = mistyped(rng, ws[-1]) if i % 2 else ws[-1]
        rows.append((i, "G", rng.choice([str.upper, str.lower, str])(" ".join(ws))))
        want[i] = f"E{k}"
    for i, v in enumerate(["astronomia", "teatro de rua", "pesca artesanal"] * 20, 600):
        rows.append((i, "G", v))
        want[i] = "-"
    df = spark.createDataFrame(rows, "n int, grupo string, value string")
    for knowledge, least in ((vocabulary.COURT, 0.97), (canonical.Knowledge(), 0.95)):
        got = {r.n: r.canon_id for r in canonical.map_values(df, ref, knowledge=knowledge).collect()}
        assert sum(got[i] == c for i, c in want.items()) / len(want) >= least


def test_repeated_lines(spark):
    rng = random.Random(14)
    rows, planted = [], set()
    for p in range(900):
        s = p % 3
        lines = [sentence(rng) + f" {p}{i}" + "abcdefghij"[p % 10] + "klmnopqrst"[p // 10 % 10] + "uvwxyzabcd"[p // 100] for i in range(5)]
        lines = [x.replace(str(p), "") + " " + "".join(rng.choice("abcdefgh") for _ in range(12)) for x in lines]
        if p % 2 == 0:
            lines.insert(p % 5, f"Reprodução  permitida — fonte {['um', 'dois', 'três'][s]} {p}")
            planted.add((p, "text", p % 5 + 1))
        rows.append((p, f"s{s}", p, 1, "\n".join(lines), None, None))
    found = {tuple(r) for r in site_lines.repeated_lines(pages(spark, rows)).select("page_id", "field_name", "line_no").collect()}
    assert score(found, planted) == (1.0, 1.0)


def test_wrong_encodings(spark):
    rng = random.Random(15)
    rows, planted, original = [], set(), {}
    ways = [lambda t: t.encode("utf-8").decode("latin-1"), lambda t: t.encode("utf-8").decode("cp850")]
    for p in range(700):
        lines = [sentence(rng) for _ in range(6)]
        if p % 10 == 0:
            i = rng.randrange(6)
            bad = ways[p // 10 % 2](lines[i])
            if bad != lines[i]:
                original[p, i + 1] = lines[i]
                lines[i] = bad
                planted.add((p, i + 1))
        rows.append((p, "s", p, 1, "\n".join(lines), None, None))
    got = encoding.garbled_lines(pages(spark, rows)).collect()
    precision, recall = score({(r.page_id, r.line_no) for r in got}, planted)
    assert precision >= 0.99 and recall >= 0.97
    assert sum(r.restored == original.get((r.page_id, r.line_no)) for r in got) >= 0.97 * len(planted)


def test_spellings_of_names(spark):
    rng = random.Random(16)
    given, between = ["Roberto", "Marlene", "Helena", "Antônio", "Débora", "Gustavo", "Patrícia", "Severino"], ["Alves", "Dantas", "Macedo", "Farias", "Ramalho", "Queiroz"]
    syllables = ["tra", "mon", "te", "le", "du", "pa", "ga", "fi", "bi", "se", "cru", "no", "re", "la", "lu", "me"]
    rows, entity, i = [], {}, 0
    for e in range(120):
        g, b, last = rng.choice(given), rng.choice(between), "".join(rng.choice(syllables) for _ in range(4)).capitalize()
        forms = [f"{g} {b} {last}", f"{g} {b[0]}. de {last}", f"{last.upper()}, {g.upper()} {b.upper()}", f"Dr. {g} {b} {last}", f"{g} {b} {mistyped(rng, last)}", f"{mistyped(rng, g)} {b} {last}"]
        for f in [forms[0], forms[0], *rng.sample(forms[1:], 3)]:
            rows.append((i, f, None))
            entity[i] = e
            i += 1
    df = spark.createDataFrame(rows, "reg_id long, name string, number string")
    found = {(r.reg_a, r.reg_b) for r in names.links(df).collect()}
    planted = {(a, b) for a in entity for b in entity if a < b and entity[a] == entity[b]}
    precision, recall = score(found, planted)
    assert precision >= 0.99 and recall >= 0.95


def test_fill_and_shares(spark):
    rng = random.Random(17)
    docs = spark.createDataFrame([(i, f"s{i % 3}", " ".join(sentence(rng) for _ in range(rng.randint(1, 12)))) for i in range(1500)], "doc_id long, source string, text string")
    kinds = spark.createDataFrame([(1, 512), (2, 2048)], "recipiente_id int, capacidade_tokens int")
    fill = {}
    for r in packing.containers_of(docs, kinds).groupBy("recipiente_id", "container").sum("tokens").collect():
        fill.setdefault(r.recipiente_id, []).append(r[2])
    for kind, capacity in ((1, 512), (2, 2048)):
        assert max(fill[kind]) <= capacity and sum(fill[kind]) / (len(fill[kind]) * capacity) >= 0.97
    targets = spark.createDataFrame([(1, "s0", 0.5, 2), (1, "s1", 0.3, 2), (1, "s2", 0.2, 1)], "mistura_id int, source string, alvo double, max_repeticoes int")
    for r in mixing.shares(mixing.mixed(docs, targets), targets).collect():
        assert abs(r.share - r.alvo) <= 0.002 and r.most_copies <= r.max_repeticoes


def test_sentences_of_several_languages(spark):
    rng = random.Random(18)
    kinds = {
        "pt": ["O Dr. Lima mediu 1.234,56 m no dia 2.", "Houve dano?", "Sim, conforme o art. 5 da lei.", "A obra parou!"], "en": ["Mr. Lee paid $1.50 on 3 May.", "Was it late?", "The roof (old) leaked."],
        "de": ["Am 3. Mai kam Dr. Weiss.", "Er sah z. B. den Riss."], "zh": ["法院认为证据充分。", "为什么没有签字？", "鉴定费用为3.5万元。"], "ru": ["Суд установил ул. Ленина, д. 5.", "Эксперт ответил."],
    }
    rows, planted = [], set()
    for i in range(500):
        lang = rng.choice(sorted(kinds))
        parts = [rng.choice(kinds[lang]) for _ in range(rng.randint(1, 40))]
        at, text = 0, ""
        for p in parts:
            sep = "" if lang == "zh" or not text else " "
            text += sep + p
            planted.add((i, at + len(sep), at + len(sep) + len(p)))
            at += len(sep) + len(p)
        rows.append((i, text))
    found = {tuple(r) for r in sentences.sentence_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    precision, recall = score(found, planted)
    assert precision >= 0.97 and recall >= 0.97
