"""Joining candidates with reference tables. Reference sides are left to the planner: it broadcasts what is small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.functions.text import digits, fold


def lookup(rows: DataFrame, catalogue: DataFrame, key: str, order: str) -> DataFrame:
    """Left join with the last entry of each key of a catalogue."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    last = catalogue.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", order)
    return rows.join(last, key, "left")


def looks_like_name(c: Column) -> Column:
    """Five characters or more with a letter, no address and none of the words of forms."""
    return (F.length(c) >= 5) & ~F.contains(c, F.lit("@")) & ~F.lower(c).rlike("interessad[oa]|sighop") & c.rlike("[A-Za-zÁÂÃÀÉÊÍÓÔÕÚÇáâãàéêíóôõúç]")


def clean_specialty(c: Column) -> Column:
    """A specialty without registration numbers; addresses and words of forms are none."""
    v = F.trim(c)
    v = F.when(F.contains(v, F.lit("@")) | F.lower(v).rlike("interessad[oa]|sighop"), "").otherwise(v)
    v = F.regexp_replace(v, r"(?i)\b(CPF|CNPJ|PIS|INSS|RG|CRM|CRP|CRO|COREN|CREFITO)\b.*$", "")
    return F.nullif(F.trim(F.regexp_replace(F.substring(v, 1, 120), r"\s+", " ")), F.lit(""))


def name_key(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(F.upper(fold(c)), "[^A-Z0-9 ]+", " "), " +", " ")), F.lit(""))


def resolve_people(rows: DataFrame, catalogue: DataFrame, name: str, number: str, keep: str, order: str) -> DataFrame:
    """``rows`` with the catalogue's specialty ``keep``: by document number (.9), else by name (.75, .6 if the name has several).

    Of entries with one number or name, those with a specialty come first, then those with a number, then the lower
    ``order``. A hit counts also if its entry has no specialty. Entries whose name is no name, or without name and number,
    are left out; specialties that differ in case only are one.
    """
    n = F.col(name)
    cat = catalogue.select(F.coalesce(digits(number), F.lit("")).alias("_d"), F.coalesce(F.trim(n), F.lit("")).alias("_name"), clean_specialty(F.col(keep)).alias("_v"), F.col(order).alias("_o"))
    cat = cat.where("_name <> '' or _d <> ''").where((F.col("_name") == "") | looks_like_name(F.col("_name"))).withColumn("_k", name_key(F.regexp_replace("_name", "^[,;. -]+|[,;. -]+$", "")))
    rank = F.struct(F.col("_v").isNull(), F.col("_d") == "", "_o")
    by_number = cat.where("_d <> ''").groupBy("_d").agg(F.min_by(F.struct(F.col("_v").alias("v")), rank).alias("by_number"))
    by_name = cat.where("_k is not null").groupBy("_k").agg(F.min_by(F.struct(F.col("_v").alias("v")), rank).alias("by_name"), F.countDistinct(F.lower("_v")).alias("_values"))
    out = rows.withColumn("_d", digits(number)).withColumn("_k", name_key(n)).join(by_number, "_d", "left").join(by_name, "_k", "left")
    hit = F.col("by_number").isNotNull()
    out = out.withColumn("resolved", F.when(hit, F.col("by_number.v")).otherwise(F.col("by_name.v")))
    out = out.withColumn("confidence", F.when(hit, 0.9).when(F.col("by_name").isNotNull(), F.when(F.col("_values") > 1, 0.6).otherwise(0.75)))
    return out.drop("_d", "_k", "by_number", "by_name", "_values")


def nearest(rows: DataFrame, entries: DataFrame, group: str, value: str, entry: str, tolerance: float = 0.15) -> DataFrame:
    """The entry of a row's group whose value is nearest, if within ``tolerance`` of the row's value.

    Rows and entries are ordered together once and each row looks to the nearest entry below and above, so no pairs are
    made. Ties go to the lower value. ``entries`` has ``group, value, entry``, values distinct in a group.
    """
    both = rows.withColumn("_e", F.lit(None).cast(dict(entries.dtypes)[entry])).withColumn("_ev", F.lit(None).cast("double")).withColumn("_row", F.lit(1)).unionByName(
        entries.select(group, F.col(value).cast(dict(rows.dtypes)[value]).alias(value), F.col(entry).alias("_e"), F.col(value).cast("double").alias("_ev")).withColumn("_row", F.lit(0)), allowMissingColumns=True
    )
    pair = F.when(F.col("_row") == 0, F.struct("_e", "_ev"))
    order = Window.partitionBy(group).orderBy(value, "_row")
    below = F.last(pair, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # running from the other end: a frame that reaches to the end would be summed anew for every row
    down = Window.partitionBy(group).orderBy(F.desc(value), "_row")
    above = F.last(pair, ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0))
    near = both.withColumn("_b", below).withColumn("_a", above).where("_row = 1")
    v = F.col(value).cast("double")
    db, da = F.abs(v - F.col("_b._ev")), F.abs(F.col("_a._ev") - v)
    pick = F.when(da.isNull() | (db <= da), F.col("_b")).otherwise(F.col("_a"))
    near = near.withColumn("_p", pick)
    fits = F.abs(F.col("_p._ev") - v) <= tolerance * F.abs(v)
    return near.withColumn(entry, F.when(fits, F.col("_p._e"))).drop("_e", "_ev", "_row", "_b", "_a", "_p")


def most_frequent(rows: DataFrame, key: str, value: str) -> DataFrame:
    """``key, value, n``: the commonest value of each key, ties to the lesser."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), value)).alias("b")).select(key, f"b.{value}", "b.n")


def prefer(seed: DataFrame, other: DataFrame, keys: list[str], always_other: list[str] = []) -> DataFrame:  # noqa: B006
    """Two candidate tables (``keys, field, value, confidence``) as one: the seed where the other lacks the field or is no surer."""
    s = seed.select(*keys, "field", F.struct("value", "confidence").alias("s"))
    o = other.select(*keys, "field", F.struct("value", "confidence").alias("o"))
    both = s.join(o, [*keys, "field"], "full")
    take_seed = F.col("s").isNotNull() & (F.col("o").isNull() | (F.col("s.confidence") >= F.col("o.confidence"))) & ~(F.col("field").isin(always_other) & F.col("o").isNotNull())
    pick = F.when(take_seed, F.col("s")).otherwise(F.col("o"))
    return both.select(*keys, "field", pick["value"].alias("value"), pick["confidence"].alias("confidence"))


def first_of_roles(rows: DataFrame, keys: list[str], role: str, value: str, order: list[str]) -> Column:
    """An aggregate: the value of the first role in ``order`` that has one."""
    return F.coalesce(*(F.min(F.when((F.col(role) == r) & (F.trim(F.col(value).cast("string")) != ""), F.col(value))) for r in order))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones of the same key; a null in a new row keeps the old value."""
    columns = [c for c in old.columns if c != key]
    n = new.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in columns))
    return old.join(n, key, "full").select(key, *(F.coalesce(f"_{c}", c).alias(c) for c in columns))


def insert_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows, and new ones whose key is not there yet."""
    return old.unionByName(new.join(old.select(key), key, "left_anti"))


#: Keywords of a specialty, then the area of the fee table: fixed values, the first that fits counts.
FEE_AREAS = (
    (("grafotec", "grafoscop", "grafocop", "contab", "contador"), "CIÊNCIAS CONTÁBEIS"), (("engenh", "arquitet", "civil", "insalubr", "periculos"), "ENGENHARIA E ARQUITETURA"),
    (("odont", "medic", "psiquiat"), "MEDICINA / ODONTOLOGIA"), (("assistente social", "servico social", "estudo social"), "SERVIÇO SOCIAL"), (("psicol", "entrevistadora forense"), "PSICOLOGIA"),
)


def fee_area(c: Column, areas=FEE_AREAS) -> Column:
    """The area whose first keyword a specialty holds, '' if none."""
    n, out = F.lower(fold(c)), F.lit("")
    for words, area in reversed(areas):
        out = F.when(F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(n, w)), area).otherwise(out)
    return F.coalesce(out, F.lit(""))


def match_fee(rows: DataFrame, entries: DataFrame, aliases: DataFrame, specialty: str, value: str, tolerance: float = 0.15) -> DataFrame:
    """``rows`` with ``entry`` and ``confidence``: by an alias keyword the specialty holds (.9), else the nearest value of its area within ``tolerance`` (.75).

    ``entries``: ``id, area, valor, ord``; ``aliases``: ``target_id, keyword, ord``. The first alias and, of equal differences,
    the first entry count. Keywords are found through their first word, by an equality on the words of the distinct specialties.
    """
    norm = lambda c: F.trim(F.regexp_replace(F.lower(fold(c)), r"\s+", " "))
    keys = aliases.select("target_id", norm(F.col("keyword")).alias("_kw"), "ord").where("_kw <> ''").join(entries.select(F.col("id").alias("target_id")).distinct(), "target_id", "left_semi")
    names = rows.select(specialty).where(F.col(specialty).isNotNull()).distinct().withColumn("_n", norm(F.col(specialty)))
    # a keyword may begin inside a word: its first three characters meet those at every place of the specialty
    at = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.length("_n") - 2, F.lit(1))), lambda i: F.substr("_n", i, F.lit(3))), lambda g: F.length(g) > 0)
    met = names.withColumn("_g", F.explode(F.array_distinct(at))).join(keys.withColumn("_g", F.substring("_kw", 1, 3)).where(F.length("_kw") >= 3), "_g").where(F.contains("_n", "_kw"))
    by_alias = met.groupBy(specialty).agg(F.min_by("target_id", F.struct("ord", "target_id")).alias("_alias"))
    values = entries.where(F.col("valor").isNotNull()).groupBy("area", "valor").agg(F.min_by("id", "ord").alias("_near_id"), F.min("ord").alias("_near_ord"))
    out = rows.join(by_alias, specialty, "left").withColumn("_area", fee_area(F.col(specialty))).withColumn("_v", F.col(value).cast("decimal(18,2)"))
    out = nearest(out.where("_v is not null and _v > 0"), values.select(F.col("area").alias("_area"), F.col("valor").alias("_v"), F.col("_near_id").alias("_near")), "_area", "_v", "_near", tolerance).unionByName(out.where("_v is null or _v <= 0").withColumn("_near", F.lit(None).cast(dict(entries.dtypes)["id"])))
    return out.withColumn("entry", F.coalesce("_alias", F.when(F.col("_area") != "", F.col("_near")))).withColumn("confidence", F.when(F.col("_alias").isNotNull(), 0.9).when(F.col("entry").isNotNull(), 0.75)).drop("_alias", "_area", "_v", "_near")


def best_of_kind(docs: DataFrame, keys: list[str], kind: str, pages: str, last: str, tie: str) -> DataFrame:
    """Of each kind the document with the most pages, then the latest end."""
    others = [c for c in docs.columns if c not in (*keys, kind)]
    order = F.struct(-F.col(pages), -F.col(last), tie)
    return docs.where(F.col(kind).isNotNull()).groupBy(*keys, kind).agg(F.min_by(F.struct(*others), order).alias("_r")).select(*keys, kind, "_r.*")


def or_all(rows: DataFrame, test: Column) -> DataFrame:
    """Rows that pass a test; if none passes, all of them."""
    test = F.coalesce(test, F.lit(False))
    passed = rows.agg(F.max(test).alias("_any"))  # one row
    return rows.withColumn("_t", test).join(F.broadcast(passed)).where("_t or not _any").drop("_t", "_any")


def without_party_experts(fields: DataFrame, keys: list[str], drop: list[str], expert: str = "PERITO", number: str = "CPF_PERITO", parties: tuple[str, ...] = ("PROMOVENTE", "PROMOVIDO")) -> DataFrame:
    """Candidates without the expert's fields where the expert has the name of a party and no number; all come from one pivot of the key."""
    name = F.trim(F.regexp_replace(F.lower("value"), r"\s+", " "))
    of = lambda f: F.max(F.when(F.col("field") == f, name))
    per = fields.groupBy(*keys).agg(of(expert).alias("_e"), of(number).alias("_c"), *(of(p).alias(f"_p{i}") for i, p in enumerate(parties)))
    same = F.lit(False)
    for i in range(len(parties)):
        same = same | F.coalesce(F.col("_e") == F.col(f"_p{i}"), F.lit(False))
    bad = per.where(same & (F.coalesce("_c", F.lit("")) == "") & (F.col("_e") != "")).select(*keys, F.explode(F.array(*map(F.lit, drop))).alias("field"))
    return fields.join(bad, [*keys, "field"], "left_anti")
