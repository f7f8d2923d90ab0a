"""Surrogates for personal data.

Mentions are found by one pattern, normalized, and collected as distinct entities. Each entity gets a keyed surrogate of its kind and shape:
letters for letters, digits for digits, the same punctuation and case; names come from lists of the title's gender and the name's
script. Surrogates are checked against each other and against the real entities over the whole corpus, and drawn again where they
clash, so that different entities stay different and one entity is the same everywhere. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, written

# Titles, and given and family names by gender and script.
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Señora", "г-жа"], "m": ["Mr", "Herr", "Monsieur", "Señor", "г-н"]}
NAMES = {
    "f latin": ["Anna", "Clara", "Elena", "Emma", "Julia", "Laura", "Maria", "Sofia"],
    "m latin": ["Adam", "Daniel", "David", "Felix", "Jonas", "Lucas", "Martin", "Oscar"],
    "f cyrillic": ["Анна", "Вера", "Елена", "Ирина", "Мария", "Ольга", "Софья", "Юлия"],
    "m cyrillic": ["Антон", "Борис", "Виктор", "Денис", "Иван", "Максим", "Олег", "Павел"],
    "family latin": ["Adler", "Berger", "Castel", "Duran", "Ferrer", "Keller", "Martel", "Novak", "Perrin", "Roland", "Serra", "Weber"],
    "family cyrillic": ["Белов", "Волков", "Громов", "Зимин", "Крылов", "Лебедь", "Мороз", "Орлов", "Попов", "Рыжов", "Снегов", "Титов"],
}

_HEX = "[0-9A-Fa-f]{1,4}"
_TITLE = "|".join(t for v in TITLES.values() for t in v)
KINDS = {
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{16})(?<=(?i:token|secret|password|api.?key)\s{0,3}[=:]\s{0,3}['\"]{0,1})[A-Za-z0-9_-]{16,}+",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,20})",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
          rf"|(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:(?:{_HEX}:){{1,6}}|:):{_HEX}(?::{_HEX}){{0,5}}|(?:{_HEX}:){{2,7}}:)(?![0-9A-Za-z:])",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
             r"|\+[0-9](?:[ .()/-]{0,2}[0-9]){7,14}(?![0-9])|(?<![0-9+])\([0-9]{2,5}\) ?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[ -]?){3}[0-9]{4}(?![0-9])",
    "person": rf"(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}\p{{L}}++(?: \p{{Lu}}\p{{L}}++)?",
}
ANY = "|".join(KINDS.values())
#: A text with none of these cannot hold a mention.
_HINT = rf"[0-9@]|(?i:token|secret|password|api.?key)|[A-Fa-f]:|::|{_TITLE}"


def _names(t: Column) -> Column:
    """The names that the text has after a title, and their entities."""
    return F.transform(F.regexp_extract_all(t, F.lit(KINDS["person"]), F.lit(0)),
                       lambda m: F.struct(F.regexp_replace(m, rf"^({_TITLE})\.? ", "").alias("name"), _norm(F.lit("person"), m).alias("norm")))


def _pattern(names: Column) -> Column:
    """Any mention, and the text's own names without a title; longer names come first."""
    own = F.array_join(F.reverse(F.array_sort(F.array_distinct(names["name"]))), "|")
    return F.when(F.size(names) > 0, F.concat(F.lit(ANY + r"|(?<!\p{L})(?:"), own, F.lit(r")(?!\p{L})"))).otherwise(F.lit(ANY))


def _kind(m: Column) -> Column:
    return (F.when(m.contains("@"), "email").when(m.rlike(r"^[+(]|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$"), "phone")
            .when(m.contains(":") | m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ip")
            .when(m.rlike(r"^([0-9]{4}[ -]?){3}[0-9]{4}$"), "card").when(m.rlike(rf"^({_TITLE})\.? "), "person").otherwise("secret"))


def _norm(kind: Column, m: Column) -> Column:
    """What two mentions of one entity have in common."""
    female = F.lit(rf"^({'|'.join(TITLES['f'])})\.? ")
    name = F.regexp_replace(m, rf"^({_TITLE})\.? ", "")
    return (F.when(kind.isin("phone", "card"), F.regexp_replace(m, r"[^0-9]", "")).when((kind == "email") | m.contains(":"), F.lower(m))
            .when(kind == "person", F.concat(F.when(F.regexp_like(m, female), "f ").otherwise("m "), name)).otherwise(m))


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k, i, mention, kind, norm) of every mention; ``k`` is the hash of the text."""
    t = F.col(text_col)
    found = docs.filter(t.rlike(_HINT)).select(F.col(id_col).alias("id"), t.alias("t"), _names(t).alias("names"))
    found = found.select("id", F.xxhash64("t").alias("k"), "names", F.posexplode(F.regexp_extract_all("t", _pattern(F.col("names")), F.lit(0))).alias("i", "mention"))
    own = F.get(F.filter("names", lambda x: x["name"] == F.col("mention")), F.lit(0))["norm"]
    found = found.withColumn("own", own).withColumn("kind", F.when(F.col("own").isNotNull(), "person").otherwise(_kind(F.col("mention"))))
    return found.select("id", "k", "i", "mention", "kind", F.coalesce("own", _norm(F.col("kind"), F.col("mention"))).alias("norm"))


def _drawn(secret: str) -> Column:
    """Surrogate of (kind, norm) at the given attempt. Later attempts add characters, so that small spaces do not run out."""
    seed = F.sha2(F.concat_ws("|", F.lit(secret), "kind", "norm", F.col("attempt").cast("string")), 256)

    def pick(i, n):
        return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")

    def letter(c, i):
        return (F.when(c.rlike("[0-9]"), pick(i, 10).cast("string"))
                .when(c.rlike("[a-z]"), F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), pick(i, 26) + 1, F.lit(1)))
                .when(c.rlike("[A-Z]"), F.substr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), pick(i, 26) + 1, F.lit(1))).otherwise(c))

    def hexdigit(c, i):
        return F.when(c.rlike("[0-9a-f]"), F.substr(F.lit("0123456789abcdef"), pick(i, 16) + 1, F.lit(1))).otherwise(letter(c, i))

    def each(text, f):
        return F.array_join(F.transform(F.split(text, ""), f), "")

    extra = F.when(F.col("attempt") > 3, F.substr(F.conv(F.substr(seed, F.lit(1), F.lit(12)), 16, 10), F.lit(1), F.col("attempt") - 3)).otherwise("")
    local, domain = F.substring_index("norm", "@", 1), F.substring_index("norm", "@", -1)
    script = F.when(F.col("norm").rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

    def named(group, i):
        lists = F.create_map(*[x for k, v in NAMES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
        own = lists[group]
        return F.get(own, F.pmod(F.xxhash64(seed, i), F.size(own)).cast("int"))

    family = named(F.concat(F.lit("family "), script), F.lit(2))
    longer = F.array_join(F.transform(F.sequence(F.lit(0), F.col("attempt")), lambda i: named(F.concat(F.lit("family "), script), i + 3)), "-")
    whole = F.col("norm").rlike(r"^. \S+ \S+$")
    given = named(F.concat(F.substr("norm", F.lit(1), F.lit(1)), F.lit(" "), script), F.lit(1))
    person = F.concat(F.substr("norm", F.lit(1), F.lit(2)), F.when(whole, F.concat(given, F.lit(" "), F.when(F.col("attempt") == 0, family).otherwise(longer)))
                      .otherwise(F.when(F.col("attempt") == 0, family).otherwise(longer)))
    ip = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (pick(i, 254) + 1).cast("string")), ".")
    ip = F.when(F.col("norm").contains(":"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.lower(F.hex(pick(i, 65535) + 1))), ":")).otherwise(ip)
    digits = F.concat(F.substr("norm", F.lit(1), F.lit(1)), each(F.substr("norm", F.lit(2)), letter))
    return (F.when(F.col("kind") == "email", F.concat(each(local, letter), extra, F.lit("@"), domain)).when(F.col("kind") == "ip", ip)
            .when(F.col("kind").isin("phone", "card"), F.concat(digits, extra)).when(F.col("kind") == "person", person)
            .otherwise(F.concat(F.when(F.col("norm").rlike("^[0-9a-f]+$"), each(F.col("norm"), hexdigit)).otherwise(each(F.col("norm"), letter)), extra)))


def surrogates(entities: DataFrame, secret: str, attempts: int = 64) -> DataFrame:
    """(kind, norm, surrogate): no two entities of a kind share a surrogate, and none is a real entity."""
    settled = None
    drawn = written(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", _drawn(secret)), "drawn")
    for attempt in range(attempts):
        real = drawn.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
        owner = drawn.groupBy("kind", "surrogate").agg(F.min("norm").alias("owner"))
        checked = drawn.join(owner, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        drawn = written(checked.withColumn("clash", (F.col("owner") != F.col("norm")) | F.col("real").isNotNull()).select(
            "kind", "norm", "attempt", "surrogate", "clash"), "checked")
        if not drawn.filter("clash").take(1):
            return drawn.select("kind", "norm", "surrogate")
        drawn = drawn.withColumn("attempt", F.col("attempt") + F.col("clash").cast("int"))
        drawn = written(drawn.withColumn("surrogate", F.when(F.col("clash"), _drawn(secret)).otherwise(F.col("surrogate"))).drop("clash"), "drawn")
    raise ValueError(f"surrogates still clash after {attempts} attempts")


def _shaped() -> Column:
    """The surrogate in the form of the mention: its punctuation, its case, its title."""
    m, s = F.col("mention"), F.col("surrogate")
    digits = F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: F.when(
        F.substr(m, i, F.lit(1)).rlike("[0-9]"), F.substr(s, F.length(F.regexp_replace(F.substr(m, F.lit(1), i), r"[^0-9]", "")), F.lit(1)))
        .otherwise(F.substr(m, i, F.lit(1)))), "")
    more = F.substr(s, F.length(F.regexp_replace(m, r"[^0-9]", "")) + 1)
    title = F.regexp_extract(m, rf"^(?:{_TITLE})\.? ", 0)
    return (F.when(F.col("kind").isin("phone", "card"), F.concat(digits, more)).when((F.col("kind") == "email") & (m == F.upper(m)), F.upper(s))
            .when(F.col("kind") == "person", F.concat(title, F.substr(s, F.lit(3)))).otherwise(s))


def pseudonymized(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and n_<kind> for every kind.

    A null text stays null, a text without mentions as it is; other columns stay, whatever their names (a new column whose name is taken gets
    an underscore). The same entity has the same surrogate in every row; repeated rows (same id, same text) get equal texts. The
    secret decides the surrogates and is not in the result.
    """
    return apart(docs, [id_col, text_col], lambda d: _replaced(d, secret, id_col, text_col))


def _replaced(docs: DataFrame, secret: str, id_col: str, text_col: str) -> DataFrame:
    found = written(mentions(docs, id_col, text_col), "mentions")
    entities = found.select("kind", "norm").distinct()
    named = found.join(surrogates(entities, secret), ["kind", "norm"]).select("id", "k", "i", "kind", _shaped().alias("s"))
    named = named.distinct().groupBy("id", "k").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("_s"),
        *[F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}") for kind in KINDS])
    named = named.withColumnsRenamed({"id": "_id", "k": "_k"})
    t = F.col(text_col)
    counts = [f"n_{kind}" for kind in KINDS]
    hinted = F.coalesce(t.rlike(_HINT), F.lit(False))
    out = docs.filter(hinted).join(named, F.col(id_col).eqNullSafe(F.col("_id")) & (F.xxhash64(t) == F.col("_k")), "left")
    out = out.withColumn("_rest", F.split(t, _pattern(_names(t))))
    text = F.when(F.col("_s").isNull(), t).otherwise(F.array_join(F.transform(
        F.col("_rest"), lambda x, i: F.concat(x, F.coalesce(F.get("_s", i), F.lit("")))), ""))
    out = out.select(*[(text if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns],
                     *[F.coalesce(c, F.lit(0)).cast("long").alias(f"{c}") for c in counts])
    return out.union(docs.filter(~hinted).select(*[F.col(f"`{c}`") for c in docs.columns], *[F.lit(0).cast("long").alias(c) for c in counts]))
