"""Variant spellings of names typed by people.

Names are read into parts (given name, names between, last name or an organisation's own word, suffix such as Júnior), with
titles, legal forms and phrases left out and the order restored. Parts that differ by a typing error are found with the
pigeonhole segment join of :mod:`lavra.llm.similarity` over the distinct parts, and verified by banded edit distance
in the context of the other parts. Then the distinct forms under one last name are resolved: full names first, then
abbreviations, nicknames and shortened names, each only where one person fits. A document number that another name holds
more often is borrowed and doesn't count; numbers a digit apart are one; else two numbers under one name are two namesakes.

Defined results: null, blank and phrase names are in no pair; repeated rows are rows of their own and pair with each other;
a form that fits several people stays by itself. Groups are of distinct forms, so repeated rows never pile up in a task, and
a last name is solved in parts that share no initial of a given name (forms of two parts can't be one person). The links of
an entity of many rows are spread over salts. What is learned of the words of names is held while it has at most
``BROADCAST_ROWS`` rows and joined to each row's words beyond; both give the same.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.similarity import damerau, near_pairs
from lavra.runtime import bounded, cut, map_batches

PARTICLES = {"da", "de", "do", "das", "dos", "di", "del"}
TITLES = {"dr", "dra", "sr", "sra", "perito", "perita", "prof", "profa", "exmo", "exma", "ilmo", "ilma", "doutor", "doutora", "sua"}
SUFFIXES = {"junior": "jr", "jr": "jr", "filho": "filho", "neto": "neto", "sobrinho": "sobrinho", "segundo": "segundo"}
LEGAL = {"ltda", "me", "eireli", "epp", "sa", "ss", "mei", "cia", "limitada"}
#: What the words of an organisation's name say about its kind; fixed values.
KINDS = {
    "avaliacoes": "avaliacoes", "avaliacao": "avaliacoes", "avaliador": "avaliacoes", "avaliadora": "avaliacoes", "aval": "avaliacoes", "centro": "", "ctro": "", "instituto": "", "inst": "",
    "pericias": "pericias", "pericial": "pericias", "periciais": "pericias", "laboratorio": "", "lab": "", "genetica": "genetica",
    "genetico": "genetica", "clinica": "", "clin": "", "psicologia": "psicologia", "psicologica": "psicologia", "psicol": "psicologia",
    "psic": "psicologia", "assessoria": "", "assess": "", "contabil": "contabil", "contabeis": "contabil", "contabilidade": "contabil",
    "cont": "contabil", "engenharia": "engenharia", "eng": "engenharia", "consultoria": "", "consult": "", "consultores": "", "servicos": "",
    "empresa": "", "escritorio": "", "grupo": "",
}
PHRASE = {"juizo", "nomeado", "nomeada", "autos", "dados", "conta", "comarca", "nome", "seguir", "informar", "definir", "banco", "agencia", "nos", "vara", "tribunal", "processo"}
#: Short forms of given names in general use; fixed values.
NICKNAMES = {
    "beto": "roberto adalberto alberto gilberto humberto norberto", "ze": "jose", "zeca": "jose zacarias", "zezinho": "jose", "chico": "francisco",
    "chica": "francisca", "fco": "francisco", "fca": "francisca", "tonho": "antonio", "toninho": "antonio", "toni": "antonio", "lena": "helena marlene",
    "paty": "patricia", "pati": "patricia", "guga": "gustavo", "guto": "gustavo augusto", "gerinho": "rogerio", "rogerinho": "rogerio",
    "lu": "lucia luciana luis luiz", "lucinha": "lucia", "bene": "benedito benedita", "dito": "benedito", "dita": "benedita", "mila": "camila",
    "sev": "severino", "biu": "severino", "bil": "severino", "quim": "joaquim", "quincas": "joaquim", "tete": "terezinha tereza", "teca": "terezinha tereza",
    "tere": "terezinha tereza", "nando": "fernando", "bia": "beatriz", "dete": "bernadete", "bete": "elisabete", "cida": "aparecida",
    "nena": "helena", "zaca": "zacarias", "tiao": "sebastiao", "tiana": "sebastiana", "bastiana": "sebastiana", "nato": "natalia renato",
    "nat": "natalia", "dani": "daniel daniela", "gu": "gustavo", "ceica": "conceicao", "con": "conceicao", "vava": "valdir evandro", "dida": "valdir",
    "leo": "leonidas leonardo", "tavo": "otavio gustavo", "tavinho": "otavio", "binho": "fabio", "fabinho": "fabio", "marcinho": "marcio",
    "paulinho": "paulo", "nelsinho": "nelson", "helinho": "helio", "adal": "adalberto", "deba": "debora", "debinha": "debora", "rosa": "rosangela",
    "ro": "rosangela rogerio roberto", "glau": "glaucia", "flavinha": "flavia", "soninha": "sonia", "taninha": "tania", "nice": "eunice", "dri": "adriana",
}


def fold(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))


def swapped_gender(a: str, b: str) -> bool:
    """Two names that differ only in a final o or a are two names."""
    return len(a) == len(b) and a[:-1] == b[:-1] and {a[-1], b[-1]} == {"o", "a"}


def words(name: str) -> tuple[list[str], bool]:
    """The words of a name without titles, and whether the last name was written first, before a comma."""
    s = fold(name)
    s = re.sub(r"\([ao]\)|\(a\)\.?", " ", s)
    s = re.sub(r"s[/.]\s?a\b\.?", " sa ", s)
    s = re.sub(r"\s-\s.*$", " ", s.strip())
    s = s.strip(" ,.;-")
    head, comma, tail = s.partition(",")
    first = comma and tail.strip() and len(head.split()) <= 3
    out = re.findall(r"[a-z]+", f"{tail} {head}" if first else s.replace(",", " "))
    return [w for w in out if w not in TITLES], bool(first)


def is_phrase(name: str) -> bool:
    s = fold(name)
    return bool(re.search(r"[:;@\d]", s)) or bool(set(re.findall(r"[a-z]+", s)) & PHRASE) or not re.search(r"[a-z]{3}", s) or bool(re.search(r"\b(?:de|da|do|dos|das)\W*$", s))


def near(a: str, b: str) -> bool:
    return a == b or min(len(a), len(b)) >= 4 and not swapped_gender(a, b) and damerau(a, b, 1) is not None


def organisation(ws: list[str]) -> tuple[str, str] | None:
    """Kind and own word of an organisation, or None for a person."""
    marks = [w for w in ws if w in KINDS]
    if not marks or marks == ["eng"] and not set(ws) & LEGAL:  # also an engineer's title
        return None
    kinds, own = set(), []
    for w in ws:
        if w in LEGAL or w in PARTICLES or w == "e":
            continue
        m = w if w in KINDS else next((k for k in KINDS if len(k) >= 5 and near(w, k)), None)
        if m is None:
            own.append(w)
        elif KINDS[m]:
            kinds.add(KINDS[m])
    return (" ".join(sorted(kinds)), " ".join(own)) if own else None


def part_counts(rows: DataFrame) -> DataFrame:
    """``part, first, n``: words of people's names, and how often they come first."""

    def run(batches):
        counts: dict[str, list[int]] = {}
        for (names,) in batches:
            for name in names:
                if not name or is_phrase(name):
                    continue
                ws, _ = words(name)
                if organisation(ws):
                    continue
                ws = [w for w in ws if w not in PARTICLES and w not in SUFFIXES and w != "eng" and len(w) > 1]
                for i, w in enumerate(ws):
                    x = counts.setdefault(w, [0, 0])
                    x[0] += i == 0
                    x[1] += 1
        yield list(counts), [x[0] for x in counts.values()], [x[1] for x in counts.values()]

    return map_batches(rows.select("name"), run, "part string, first long, n long").groupBy("part").agg(F.sum("first").alias("first"), F.sum("n").alias("n"))


def parse(name: str, known: dict[str, tuple[float, str | None, bool]]) -> tuple[str, str, str, str] | None:
    """``(given, between, last, suffix)``; an organisation's kind is its given name, with ``@`` before it.

    ``known``: for a word how often it opens names, the word it is a misspelling of, and whether it is common.
    """
    if is_phrase(name):
        return None
    ws, comma = words(name)
    if org := organisation(ws):
        return "@" + org[0], "", org[1], ""
    ws = [next((x for x in SUFFIXES if len(x) >= 5 and i and near(w, x)), w) for i, w in enumerate(ws)]
    suffix = "".join(sorted({SUFFIXES[w] for w in ws[1:] if w in SUFFIXES}))
    ws = [w for i, w in enumerate(ws) if w not in PARTICLES and not (i and w in SUFFIXES) and w != "eng"]
    if len(ws) < 2:
        return None
    ws = [(known[w][1] or w) if w in known else w for w in ws]
    # A last name first without a comma: the second word opens names and the first doesn't, or what ends it is no last name.
    opens = [known[w][0] if len(w) > 1 and w in known else 0.0 for w in ws]
    common = ws[-1] in known and known[ws[-1]][2]
    if not comma and len(ws[0]) > 3 and ws[0] not in NICKNAMES and (len(ws[-1]) == 1 or opens[0] < 0.5 and (opens[1] >= 0.5 or len(ws) > 2 and (len(ws[1]) == 1 or ws[1] in NICKNAMES) and common)):
        ws = [*ws[1:], ws[0]]
    return ws[0], " ".join(ws[1:-1]), ws[-1], suffix


def same_part(a: str, b: str) -> int:
    """2: the same word; 1: one can stand for the other; 0: different."""
    if a == b:
        return 2 if len(a) > 1 else 1
    if a[:1] == "@" or b[:1] == "@":
        x, y = set(a[1:].split()), set(b[1:].split())
        return 1 if not x or not y or x <= y or y <= x else 0
    if len(a) == 1 or len(b) == 1:
        full = a if len(b) == 1 else b
        one = b if len(b) == 1 else a
        return int(full[0] == one or any(x[0] == one for x in NICKNAMES.get(full, "").split()))
    x, y = set(NICKNAMES.get(a, "").split()), set(NICKNAMES.get(b, "").split())
    if b in x or a in y or x & y:
        return 1
    short, full = sorted((a, b), key=len)
    if len(short) <= 4 and len(full) - len(short) >= 2 and len(short) >= 3 and (full.startswith(short) or full.endswith(short)):
        return 1
    return 2 if near(a, b) else 0


def same_between(a: str, b: str) -> int:
    """As :func:`same_part` for the names between; missing ones leave it open."""
    x, y = a.split(), b.split()
    if not x or not y:
        return 2 if x == y else 1
    if len(x) > len(y):
        x, y = y, x
    least, at = 2 if len(x) == len(y) else 1, 0
    for w in x:
        while at < len(y) and not same_part(w, y[at]):
            at += 1
        if at == len(y):
            return 0
        least = min(least, same_part(w, y[at]))
        at += 1
    return least


def near_numbers(a: str, b: str) -> bool:
    """Document numbers that are equal or a typing error apart."""
    return a == b or len(a) == len(b) and (sum(x != y for x, y in zip(a, b)) <= 1 or damerau(a, b, 1) is not None)


def precision(form: tuple[str, str]) -> int:
    given, between = form
    g = 4 if len(given) > 1 and given not in NICKNAMES else 2 if len(given) > 1 else 0
    b = max((3 if len(w) > 1 else 1 for w in between.split()), default=0)
    return g + b


def resolve(forms: list[tuple[str, str, str | None, int]]) -> list[int]:
    """The person of each form ``(given, between, document, rows)`` under one last name, as a number."""
    order = sorted(range(len(forms)), key=lambda i: (-precision(forms[i][:2]), forms[i][2] is None, -forms[i][3], forms[i][0], forms[i][1], forms[i][2] or ""))
    people: list[dict] = []
    out = [0] * len(forms)
    holders: dict[str, list[int]] = {}  # people by given name
    alike: dict[str, dict[str, int]] = {}  # given names seen so far that can be the same, for each one asked

    def like(given: str) -> dict[str, int]:
        if given not in alike:
            alike[given] = {h: g for h in holders if (g := same_part(given, h))}
        return alike[given]

    for i in order:
        given, between, number, rows = forms[i]
        fits = []
        for other, g in like(given).items():
            for p in holders[other]:
                x = people[p]
                if b := same_between(between, x["between"]):
                    fits.append((p, g, b, any(number is not None and near_numbers(number, d) for d in x["numbers"])))
        fits.sort()
        with_number = [f for f in fits if f[3]]
        if with_number:
            fits = with_number
        elif number is not None:
            # another own number: a namesake, unless the person has none yet
            fits = [f for f in fits if not people[f[0]]["numbers"]]
        if len(fits) > 1:
            best = max((f[1], f[2]) for f in fits)
            top = [f for f in fits if (f[1], f[2]) == best]
            names = {(people[f[0]]["given"], people[f[0]]["between"]) for f in top}
            if len(top) == 1 and (best[0] == 2 or best[1] == 2 and between):
                fits = top
            elif len(names) == 1:
                fits = [max(top, key=lambda f: (people[f[0]]["rows"], -f[0]))]
            elif with_number:
                fits = [max(top, key=lambda f: (people[f[0]]["rows"], -f[0]))]
            else:
                fits = []
        if fits:
            p = fits[0][0]
        else:
            p = len(people)
            people.append({"given": given, "between": between, "numbers": Counter(), "rows": 0})
            if given not in holders:
                holders[given] = []
                for asked, found in alike.items():
                    if g := same_part(asked, given):
                        found[given] = g
            holders[given].append(p)
        x = people[p]
        x["rows"] += rows
        if number is not None:
            x["numbers"][number] += rows
        out[i] = p
    return out


def initials(given: str) -> set[str]:
    """The first letters a given name can stand for; kinds of organisations have one of their own."""
    return {"@"} if given[:1] == "@" else {given[0], *(x[0] for x in NICKNAMES.get(given, "").split())}


def initials_column(given: str, between: str) -> Column:
    """The initials of a given name, of what a nickname stands for, and of the names between."""
    full = F.create_map(*(x for k, v in NICKNAMES.items() for x in (F.lit(k), F.array(*(F.lit("g" + n[0]) for n in v.split())))))
    middle = F.transform(F.filter(F.split(between, " "), lambda w: w != ""), lambda w: F.concat(F.lit("b"), F.substring(w, 1, 1)))
    own = F.array(F.concat(F.lit("g"), F.substring(given, 1, 1)))
    return F.array_distinct(F.concat(own, F.coalesce(full[F.col(given)], F.array().cast("array<string>")), middle))


def initial_classes(sets: list[str]) -> dict[str, str]:
    """For each set of initials the class of all sets that hang together by shared initials, named by its least initial."""
    classes: list[set[str]] = []
    for s in sets:
        mine = set(s)
        rest = []
        for c in classes:
            if c & mine:
                mine |= c
            else:
                rest.append(c)
        classes = [*rest, mine]
    return {s: min(next(c for c in classes if s[0] in c)) for s in sets}


def ends_of(moves: DataFrame) -> DataFrame:
    """``form, to, path`` with every move followed to its end by pointer jumping; ``path``: the last names on the way.

    Moves lead to a last name of more rows, or of as many and earlier in the alphabet, so they hold no circle.
    """
    moves = cut(moves.select("form", "to", "path"))
    while True:
        on = moves.select(F.col("form").alias("to"), F.col("to").alias("then"), F.col("path").alias("rest"))
        if on.join(moves.select("to"), "to", "left_semi").isEmpty():
            return moves
        moves = cut(moves.join(on, "to", "left").select("form", F.coalesce("then", "to").alias("to"), F.when(F.col("then").isNull(), F.col("path")).otherwise(F.concat("path", "rest")).alias("path")))


def _parsed(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``reg_id, given, between, last, suffix, number`` of every row that holds a name."""
    held = bounded(known)
    schema = "reg_id long, given string, between string, last string, suffix string, number string"
    as_dict = lambda ps, ss, rs, cs: {p: (s, r, c) for p, s, r, c in zip(ps, ss, rs, cs)}

    def parse_all(items):
        out: list[list] = [[] for _ in range(6)]
        for i, name, number, words in items:
            if name and (got := parse(name, words)):
                for c, v in zip(out, (i, *got, number)):
                    c.append(v)
        return out

    if held is not None:
        sent = rows.sparkSession.sparkContext.broadcast(as_dict(*(held[c].to_pylist() for c in ("part", "share", "right", "common"))))

        def read(batches):
            for ids, names, numbers in batches:
                yield parse_all((i, name, number, sent.value) for i, name, number in zip(ids, names, numbers))

        return map_batches(rows, read, schema)

    def ask(batches):
        for (names,) in batches:
            out = [(name, w) for name in names if name for w in dict.fromkeys(words(name)[0])]
            yield [x[0] for x in out], [x[1] for x in out]

    asked = map_batches(rows.select("name").distinct(), ask, "name string, part string").join(known, "part")
    told = asked.groupBy("name").agg(F.collect_list(F.struct("part", "share", "right", "common")).alias("words"))

    def read_told(batches):
        for ids, names, numbers, told in batches:
            yield parse_all((i, name, number, {x["part"]: (x["share"], x["right"], x["common"]) for x in ws or ()}) for i, name, number, ws in zip(ids, names, numbers, told))

    return map_batches(rows.join(told, "name", "left").select("reg_id", "name", "number", "words"), read_told, schema)


def entities(rows: DataFrame) -> DataFrame:
    """``reg_id, entity`` for every row of ``reg_id, name, number`` that holds a name."""
    rows = rows.select("reg_id", "name", F.nullif(F.regexp_replace("number", r"\D", ""), F.lit("")).alias("number"))
    parts = cut(part_counts(rows))
    pairs = near_pairs(parts, "part", 1)
    n = parts.select("part", "n", "first")
    both = pairs.join(n.select(F.col("part").alias("a"), F.col("n").alias("n_a")), "a").join(n.select(F.col("part").alias("b"), F.col("n").alias("n_b")), "b")
    both = cut(both)
    # Rare spellings of the closed set of given and middle names are set right by frequency alone.
    rare = both.select(F.expr("if(n_a <= n_b, a, b)").alias("part"), F.expr("if(n_a <= n_b, b, a)").alias("right"), F.expr("least(n_a, n_b)").alias("n_wrong"), F.expr("greatest(n_a, n_b)").alias("n_right"))
    total = n.agg(F.sum("n")).first()[0] or 0
    common = n.where((F.col("n") >= 3) & (F.col("n") * 400 >= total)).select("part", F.lit(True).alias("common"))
    stem = lambda c: F.expr(f"substring({c}, 1, length({c}) - 1)")
    gender = (F.length("part") == F.length("right")) & (stem("part") == stem("right")) & F.expr("array_sort(array(right(part, 1), right(`right`, 1))) = array('a', 'o')")
    fixed = rare.where("n_right >= 4 * n_wrong").join(common.withColumnRenamed("part", "right"), "right").groupBy("part").agg(F.max_by("right", F.struct("n_right", "right")).alias("right")).where(~gender)
    # a word seen once or twice at the beginning says little
    share = n.where("first * 2 >= n").select("part", (F.col("first") / (F.col("n") + 2)).alias("share"))
    known = cut(share.join(fixed, "part", "full").join(common, "part", "full").select("part", F.coalesce("share", F.lit(0.0)).alias("share"), "right", F.coalesce("common", F.lit(False)).alias("common")))
    parsed = cut(_parsed(rows, known))
    forms = parsed.groupBy("given", "between", "last", "suffix", "number").agg(F.count("*").alias("rows"))
    # A number counts for the last name that holds it most often; elsewhere it is borrowed.
    holders = forms.where("number is not null").groupBy("number", "last").agg(F.sum("rows").alias("held"))
    owner = holders.groupBy("number").agg(F.max(F.struct("held", "last")).alias("top"), F.sort_array(F.collect_list("held"), asc=False).alias("all"))
    owner = owner.select("number", F.when((F.size("all") == 1) | (F.get("all", F.lit(0)) > F.get("all", F.lit(1))), F.col("top.last")).alias("owner"))
    forms = cut(forms.join(owner, "number", "left"))

    # Last names with a typing error: another last name one edit away, under which the other parts fit.
    lasts = forms.groupBy("last").agg(F.sum("rows").alias("n"))
    close = near_pairs(lasts, "last", 1)
    close = close.select(F.col("a").alias("x"), F.col("b").alias("y")).union(close.select("b", "a"))
    close = close.join(lasts.select(F.col("last").alias("x"), F.col("n").alias("n_x")), "x").join(lasts.select(F.col("last").alias("y"), F.col("n").alias("n_y")), "y").where("n_y > n_x or n_y = n_x and y < x")
    # a short last name is one letter from many others: only a far more frequent one is meant
    close = close.where("least(length(x), length(y)) >= 5 or n_y >= 4 * n_x").select("x", "y", "n_y")
    # forms meet by an initial of their given name or of a name between, so that a last name of many people isn't paired with itself
    named = forms.withColumn("form", F.concat_ws("|", "last", "given", "between", "suffix", F.coalesce("number", F.lit(""))))
    keyed = named.withColumn("initial", F.explode(initials_column("given", "between")))
    left = keyed.join(close, keyed["last"] == close["x"]).select("y", "n_y", "form", F.col("given").alias("g1"), F.col("between").alias("b1"), "suffix", F.col("number").alias("d1"), "initial")
    met = left.join(keyed.select(F.col("last").alias("y"), F.col("form").alias("to"), F.col("given").alias("g2"), F.col("between").alias("b2"), "suffix", F.col("number").alias("d2"), "rows", "initial"), ["y", "suffix", "initial"])

    def fit(batches):
        for ys, ns, fs, g1s, b1s, d1s, ts, g2s, b2s, d2s, rs in batches:
            out: list[list] = [[] for _ in range(6)]
            for y, n, f, g1, b1, d1, t, g2, b2, d2, r in zip(ys, ns, fs, g1s, b1s, d1s, ts, g2s, b2s, d2s, rs):
                g, b = same_part(g1, g2), same_between(b1, b2)
                same = d1 is not None and d2 is not None and near_numbers(d1, d2)
                if g and b and (same or (d1 is None or d2 is None) and (g == 2 or b == 2 and b1 or len(y) >= 7) or g == 2 and b == 2 and b1):
                    for c, v in zip(out, (f, -((2 if same else 0) * 10 + g + b), -n, y, -r, t)):
                        c.append(v)
            yield out

    moves = map_batches(met.select("y", "n_y", "form", "g1", "b1", "d1", "to", "g2", "b2", "d2", "rows"), fit, "form string, score int, n long, right string, rows long, to string")
    moves = moves.groupBy("form").agg(F.min(F.struct("score", "n", "right", "rows", "to")).alias("best")).select("form", F.col("best.to").alias("to"), F.array("best.right").alias("path"))
    placed = named.join(ends_of(moves), "form", "left").withColumn("path", F.coalesce("path", F.array("last"))).withColumn("home", F.element_at("path", -1))
    placed = placed.withColumn("own", F.when((F.col("owner") == F.col("last")) | F.array_contains("path", F.col("owner")), F.col("number")))

    # forms that share no initial, not even through others, are solved apart; a last name has few sets of initials
    letters = {k: "".join(sorted(initials(k))) for k in NICKNAMES}
    own = F.create_map(*(F.lit(x) for k, v in letters.items() for x in (k, v)))
    placed = cut(placed.withColumn("initials", F.coalesce(own[F.col("given")], F.substring("given", 1, 1))))

    def classes(batches):
        for homes, suffixes, sets in batches:
            out = [(h, s, i, c) for h, s, ls in zip(homes, suffixes, sets) for i, c in initial_classes(sorted(ls)).items()]
            yield [x[0] for x in out], [x[1] for x in out], [x[2] for x in out], [x[3] for x in out]

    classed = map_batches(placed.groupBy("home", "suffix").agg(F.collect_set("initials").alias("sets")), classes, "home string, suffix string, initials string, class string")
    placed = placed.join(classed, ["home", "suffix", "initials"])

    def solve(batches):
        for homes, suffixes, classes, groups in batches:
            out: list[list] = [[] for _ in range(6)]
            for home, suffix, letter, forms in zip(homes, suffixes, classes, groups):
                people = resolve([(x["given"], x["between"], x["own"], x["rows"]) for x in forms])
                for x, p in zip(forms, people):
                    for column, v in zip(out, (x["last"], x["given"], x["between"], suffix, x["number"], f"{home}|{suffix}|{letter}|{p}")):
                        column.append(v)
            yield out

    # a row holds the distinct forms of one part of a last name
    grouped = placed.groupBy("home", "suffix", "class").agg(F.collect_list(F.struct("last", "given", "between", "number", "own", "rows")).alias("forms"))
    spread = grouped.repartition(max(12, placed.sparkSession.sparkContext.defaultParallelism))
    solved = map_batches(spread, solve, "last string, given string, between string, suffix string, number string, entity string")
    solved = cut(solved)
    on = [parsed[c].eqNullSafe(solved[c]) for c in ("last", "given", "between", "suffix", "number")]
    return parsed.join(solved, on).select("reg_id", "entity")


def links(rows: DataFrame, salt: int = 2000) -> DataFrame:
    """``reg_a, reg_b``: all pairs of rows whose names mean the same; an entity is spread over a salt for each ``salt`` rows."""
    e = cut(entities(rows).where("reg_id is not null"))
    sizes = e.groupBy("entity").agg(F.ceil(F.count("*") / salt).cast("int").alias("salts")).where("salts > 1")
    e = e.join(sizes, "entity", "left").fillna(1, ["salts"])
    left = e.select(F.col("reg_id").alias("reg_a"), "entity", F.pmod(F.xxhash64("reg_id"), F.col("salts")).cast("int").alias("salt"))
    right = e.select(F.col("reg_id").alias("reg_b"), "entity", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return left.join(right, ["entity", "salt"]).where("reg_a < reg_b").select("reg_a", "reg_b")
