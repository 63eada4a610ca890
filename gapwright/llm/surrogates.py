"""Personal data: detected entities receive keyed, type-consistent surrogates.

E-mail and IP addresses, telephone, card, account and social security numbers and names after a title are
found by pattern. An entity is a kind and a normal form (small letters, digits alone), and it has one
surrogate in the whole corpus, however it is written there. Surrogates come from a keyed digest: digits
stay digits in the same places (country code and the card's check digit included), a given name keeps
gender and script, a surname its script, and a word written in capitals stays so.

Two entities of one kind never share a surrogate, and no surrogate is an entity of the corpus: what collides
is drawn again, the entity first in order keeping its draw, until nothing collides.

The patterns go over each text once, into a table in the shared folder; only texts with entities are shuffled,
to meet their surrogates. An entity that a third of all documents name is one row of the table of entities, and
its occurrences are split by the join. Missing texts stay
missing. Rows that repeat get equal results, and missing ids are matched like others. Other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwright.llm.common import cut, cut_table, id_and_text

#: Fixed lists: titles by gender, in the languages at hand.
MALE_TITLES = "Mr|Herr|Herrn|Monsieur|Señor|Sr|Don|Sir|господин|κύριος"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Madame|Mme|Mademoiselle|Señora|Sra|Señorita|Doña|Lady|госпожа|κυρία"
OTHER_TITLES = "Dr|Prof"

#: Fixed lists: given names that surrogates are drawn from, by script and gender.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Noah Oscar Paul Robert Simon Tomas Victor",
    ("latin", "f"): "Anna Berta Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nina Olga Paula Rosa Sarah Teresa Vera",
    ("latin", "n"): "Alex Andrea Chris Dominique Eden Jamie Kim Lee Robin Sascha",
    ("cyrillic", "m"): "Антон Борис Виктор Денис Егор Иван Лев Максим Олег Павел",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Ирина Мария Нина Ольга Юлия",
    ("cyrillic", "n"): "Саша Женя Валя Шура",
    ("greek", "m"): "Αλέξανδρος Γιάννης Δημήτρης Κώστας Νίκος Πέτρος",
    ("greek", "f"): "Άννα Ελένη Μαρία Σοφία Χριστίνα Δήμητρα",
    ("greek", "n"): "Αγάπη Χαρά",
}

#: Fixed lists: syllables that surnames, and given names after a collision, are made of.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga ge ha he ka ke la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve wa we za ze",
    "cyrillic": "ба бе бо ва ве да де до га ге ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то",
    "greek": "βα βε γα γε δα δε κα κε κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε σο τα τε το",
}
ENDINGS = {"latin": {"m": "n", "f": "a", "n": "i"}, "cyrillic": {"m": "н", "f": "а", "n": "и"}, "greek": {"m": "ς", "f": "α", "n": "ι"}}

_TITLE = rf"(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})\.?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

#: Patterns, the first that matches at a place counts. They can't begin inside a longer word or number.
#: A telephone number has seven digits at least.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?<=\.[A-Za-z]{2,24})",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "account": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)[\x20.-]?)?\d{1,4}(?:[\x20.-]?\d{2,4}){1,4}|\(\d{3}\)\x20?\d{3}[\x20.-]\d{4}|\d{3}[\x20.-]\d{3}[\x20.-]\d{4})(?<=\d" + r"[\x20.()-]{0,2}\d" * 6 + r")(?!\d)",
    "ssn": r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])",
    "card": r"(?<![\p{L}\p{N}.-])\d(?:[\x20-]?\d){12,18}(?![\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])\p{{Lu}}(?:(?<=(?<![\p{{L}}]){_TITLE}\x20\p{{Lu}})|(?<=(?<![\p{{L}}]){_TITLE}\x20\p{{Lu}}\p{{L}}{{1,20}}\x20\p{{Lu}}))[\p{{L}}’'-]*\p{{L}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
KINDS = [*PATTERNS]


def _kind(hit: Column) -> Column:
    """Which pattern matched, told by the shape of the match."""
    digits = F.length(F.regexp_replace(hit, r"\D", ""))
    return (
        F.when(F.instr(hit, "@") > 0, "email")
        .when(hit.rlike(r"^\p{Lu}(?!\p{Lu}\d\d)"), "name")
        .when(hit.rlike("^[A-Z]"), "account")
        .when(hit.rlike(r"^\d+\.\d+\.\d+\.\d+$") & (digits <= 12) & ~hit.rlike(r"^\d{3}\.\d{3}\.\d{4}$"), "ip")
        .when(hit.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(hit.rlike(r"^[+(]") | hit.rlike(r"^\d{3}[\x20.-]\d{3}[\x20.-]\d{4}$"), "phone")
        .otherwise("card")
    )


def _normal(kind: Column, hit: Column) -> Column:
    return F.when(kind.isin("phone", "ssn", "card"), F.regexp_replace(hit, r"\D", "")).when(kind == "account", F.translate(hit, " ", "")).otherwise(F.lower(hit))


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, text, gaps, hits): pieces of text between entities, and the entities as (hit, kind, normal)."""
    rows = id_and_text(docs, id_col, text_col)
    has = F.col("text").rlike(ANY)
    rows = rows.select(
        "doc_id",
        F.xxhash64("text").alias("tag"),
        "text",
        F.when(has, F.split("text", ANY, -1)).alias("gaps"),
        F.when(has, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("found"),
    )
    gap = lambda i: F.get("gaps", i)

    def described(hit, i):
        kind = _kind(hit)
        before = gap(i)
        # a name directly after a title is a given name if another follows, else a surname
        titled = before.rlike(rf"{_TITLE}\x20$")
        paired = (gap(i + 1) == " ") & F.coalesce(_kind(F.get("found", i + 1)) == "name", F.lit(False))
        gender = F.when(before.rlike(rf"(?:{MALE_TITLES})\.?\x20$"), "m").when(before.rlike(rf"(?:{FEMALE_TITLES})\.?\x20$"), "f").otherwise("n")
        part = F.when(titled & paired, F.concat(F.lit("given_"), gender)).otherwise("surname")
        kind = F.when(kind == "name", F.concat(part, F.lit("_"), _script(hit))).otherwise(kind)
        return F.struct(hit.alias("hit"), kind.alias("kind"), _normal(kind, hit).alias("normal"))

    return rows.select("doc_id", "tag", "text", "gaps", F.transform("found", described).alias("hits"))


def _number(kind: Column, normal: Column, attempt: Column, key: str, salt: str | Column) -> Column:
    """A keyed number of 60 bits for an entity's draw."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, normal, attempt.cast("string"), salt if isinstance(salt, Column) else F.lit(salt)), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _drawn(values: str, number: Column) -> Column:
    items = values.split()
    return F.get(F.array(*[F.lit(x) for x in items]), F.pmod(number, F.lit(len(items))).cast("int"))


#: Attempts after which a name or number that still collides grows by a syllable or digit with each attempt.
PLAIN_ATTEMPTS = {"name": 1, "number": 8}


def draw(key: str) -> Column:
    """The surrogate of (kind, normal) at an attempt, in normal form; later attempts draw from larger spaces."""
    kind, normal, attempt = F.col("kind"), F.col("normal"), F.col("attempt")
    number = lambda salt: _number(kind, normal, attempt, key, salt)
    # digits: two blocks of a digest cover the longest number
    blocks = F.concat(*[F.lpad(number(s).cast("string"), 18, "0") for s in ("d0", "d1")])
    n = F.length(normal)
    more = lambda what: F.greatest(attempt - PLAIN_ATTEMPTS[what], F.lit(0))
    digits = F.substring(F.reverse(blocks), F.lit(1), n)
    luhn = lambda text: F.aggregate(
        F.split(F.reverse(text), ""),
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("sum")),
        lambda s, c: F.struct((s["i"] + 1).alias("i"), (s["sum"] + F.when(s["i"] % 2 == 0, c.cast("int")).otherwise(F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int")))).alias("sum")),
        lambda s: s["sum"] % 10,
    )
    # a card keeps its first digit, and passes or fails the check as the original does
    body = F.concat(F.substring(normal, 1, 1), F.substring(digits, F.lit(2), n - 2))
    check = F.pmod(10 - luhn(F.concat(body, F.lit("0"))) + luhn(normal), F.lit(10)).cast("string")
    card = F.concat(body, check)
    phone = F.when(n > 10, F.concat(F.substring(normal, F.lit(1), F.greatest(n - 10, F.lit(1))), F.substring(digits, F.lit(1), n - F.greatest(n - 10, F.lit(1))))).otherwise(digits)
    tail = F.substring(F.reverse(blocks), n + 1, more("number"))
    phone = F.concat(phone, tail)
    ssn = F.concat(F.lit("9"), F.substring(digits, F.lit(2), n - 1), tail)
    account = F.concat(F.substring(normal, 1, 2), F.array_join(F.transform(F.split(F.substring(normal, F.lit(3), n), ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(blocks, i % 34 + 1, F.lit(1))).otherwise(F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.pmod(F.xxhash64(F.lit(key), normal, attempt, i), F.lit(26)).cast("int") + 1, F.lit(1)))), ""))
    octet = lambda salt: F.pmod(number(salt), F.lit(256)).cast("string")
    # reserved addresses, so that no surrogate is anyone's
    ip = F.concat_ws(".", (240 + F.pmod(number("o0"), F.lit(15))).cast("string"), octet("o1"), octet("o2"), octet("o3"))
    letters = lambda salt, count: F.concat(*[_drawn(SYLLABLES["latin"], number(f"{salt}{i}")) for i in range(count)])
    email = F.concat(letters("u", 4), F.lit("."), F.pmod(number("un"), F.lit(10_000)).cast("string"), F.lit("@"), letters("h", 2), F.lit(".example."), _drawn("com net org", number("t")))
    value = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone).when(kind == "ssn", ssn).when(kind == "account", account)
    for script, syllables in SYLLABLES.items():
        made = lambda salt, count: F.array_join(F.transform(F.sequence(F.lit(0), more("name") + (count - 1)), lambda i: _drawn(syllables, number(F.concat(F.lit(salt), i.cast("string"))))), "")  # noqa: E731,B023
        value = value.when(kind == f"surname_{script}", made("s", 4))
        for gender, ending in ENDINGS[script].items():
            listed = F.lower(_drawn(GIVEN[script, gender], number("g")))
            value = value.when(kind == f"given_{gender}_{script}", F.when(attempt == 0, listed).otherwise(F.concat(made("g", 3), F.lit(ending))))
    return value


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, normal, surrogate) for distinct (kind, normal): distinct within a kind, and none an entity itself."""
    drawn = cut(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw(key)))
    while True:
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "normal")).alias("keeper"))
        taken = entities.select("kind", F.col("normal").alias("surrogate"), F.lit(True).alias("real"))
        judged = drawn.join(first, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        again = (F.col("keeper.normal") != F.col("normal")) | F.coalesce("real", F.lit(False))
        judged = judged.select("kind", "normal", "surrogate", "attempt", again.alias("again"))
        if judged.where("again").isEmpty():
            return drawn.select("kind", "normal", "surrogate")
        retried = judged.where("again").select("kind", "normal", (F.col("attempt") + 1).alias("attempt")).withColumn("surrogate", draw(key))
        drawn = cut(judged.where("not again").select("kind", "normal", "attempt", "surrogate").unionByName(retried))


def written(hit: Column, kind: Column, surrogate: Column) -> Column:
    """A surrogate in the format of an occurrence."""
    put = F.aggregate(
        F.split(hit, ""),
        F.struct(F.lit(1).alias("at"), F.lit("").alias("out")),
        lambda s, c: F.struct(
            (s["at"] + F.when(c.rlike("[0-9A-Z]"), 1).otherwise(0)).alias("at"),
            F.concat(s["out"], F.when(c.rlike("[0-9A-Z]"), F.substring(surrogate, s["at"], F.lit(1))).otherwise(c)).alias("out"),
        ),
        # a number that grew has its last digits behind
        lambda s: F.concat(s["out"], F.substring(surrogate, s["at"], F.length(surrogate))),
    )
    upper = (F.length(hit) > 1) & (F.upper(hit) == hit) & (F.lower(hit) != hit)
    return (
        F.when(kind.isin("phone", "ssn", "card", "account"), put)
        .when(kind.isin("email", "ip"), F.when(upper, F.upper(surrogate)).otherwise(surrogate))
        .otherwise(F.when(upper, F.upper(surrogate)).otherwise(F.initcap(surrogate)))
    )


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_<kind>, n_entities, text): every whole text with its entities replaced."""
    # the patterns go over the texts once; a text is kept whole or in pieces
    found = occurrences(docs, id_col, text_col)
    found = cut_table(found.withColumn("text", F.when(F.col("hits").isNull(), F.col("text"))))
    rows = found.where("hits is not null").drop("text")
    each = rows.select("doc_id", "tag", F.posexplode("hits").alias("place", "hit")).select("doc_id", "tag", "place", "hit.*")
    table = surrogates(cut(each.select("kind", "normal").distinct()), key)
    replaced = each.join(table, ["kind", "normal"]).select("doc_id", "tag", F.struct("place", "kind", written(F.col("hit"), F.col("kind"), F.col("surrogate")).alias("text")).alias("part"))
    # a set, as rows that repeat bring the same parts
    lists = replaced.groupBy(F.col("doc_id").alias("key"), F.col("tag").alias("key_tag")).agg(F.sort_array(F.collect_set("part")).alias("parts"))
    met = rows.drop("hits").join(lists, F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("tag") == F.col("key_tag")), "left")
    parts = F.col("parts")
    text = F.array_join(F.transform("gaps", lambda gap, i: F.concat(gap, F.coalesce(F.get(parts, i)["text"], F.lit("")))), "")
    counts = [F.size(F.filter(F.transform(parts, lambda p: p["kind"]), _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    changed = met.select("doc_id", *counts, F.size(parts).cast("long").alias("n_entities"), text.alias("text"))
    none = F.lit(0).cast("long")
    plain = found.where("hits is null").select("doc_id", *[none.alias(f"n_{k}") for k in KINDS], none.alias("n_entities"), "text")
    return changed.unionByName(plain)


def _is(kind: str):
    """Whether a kind of the table is one that is counted under this name."""
    if kind == "name":
        return lambda k: k.startswith("given_") | k.startswith("surname_")
    return lambda k: k == kind
