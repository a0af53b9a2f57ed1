"""PII surrogates in DataFrame functions only.

Texts are cut at the matches of one pattern. The distinct matches (entities) get
keyed surrogates: SHA-256 of key, type, value and attempt drives a replacement
of the same type and format, character class by character class, so that equal
entities have equal surrogates in all texts (coreference). Surrogates are then
checked: two entities with one surrogate, or a surrogate that is itself an
entity of the corpus, take another attempt until all are distinct and new.

Types: e-mail, telephone, card (valid check digit), IPv4, social security
number, account (IBAN), access keys and quoted or assigned secrets, and names
after a title. A name keeps its title, script and gender: syllables of its own
alphabet, with a feminine or masculine ending for given names as the title says.
The last name is replaced by itself, so "Mrs Ana Ruiz" and "Mrs Ruiz" stay one.
A text that repeats the full name without its title has its surrogate there too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

#: Type and pattern; the first that a match satisfies as a whole names its type.
TITLES = {"m": r"Mr|Sir|Herr|Señor|Sr|Monsieur|Don|Г-н", "f": r"Mrs|Ms|Miss|Madam|Frau|Señora|Señorita|Sra|Madame|Mme|Mlle|Doña|Г-жа", "n": r"Dr|Prof|Professor|Doctor"}
_TITLE = "|".join(TITLES[g] for g in ("f", "m", "n"))
#: A part of a name: capitalised in any way (McDonald, O'Brien, SMITH, Lopez-Ruiz), or an initial; and the small words between parts.
_PART = r"(?:\p{Lu}[\p{L}'’]+(?:-\p{Lu}[\p{L}'’]+)*+|\p{Lu}\.)"
_SMALL = r"(?:(?:de la|de los|van der|van den|von der|de|del|da|dos|di|la|le|van|von|der|den|ten|bin|al|y) )?"
_MORE = rf"(?: {_SMALL}{_PART})"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?i:password|passwd|pwd|secret|api[_-]?key|token|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_.~-]{6,}+[\"']?",
    "key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}+|\bsk-[A-Za-z0-9]{20,}+[A-Za-z0-9_-]*+",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\d.-])(?:(?:\d{4}[ -]?){3}\d{1,7}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?![\d-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\d-])"
             r"|(?<=(?i:phone|tel|telephone|call|mobile|cell|fax)[:. ]{1,3})\d{7,15}(?!\d)",
    "ip": r"(?<![\d.])(?<![vV])(?<![vV][ .])(?<!ersion )(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": rf"\b(?:(?:{_TITLE})\.?|MRS?\.?) {_SMALL}{_PART}{_MORE}*+",
}
_FULL = rf"(?:(?:{_TITLE})\.?|MRS?\.?) {_SMALL}{_PART}{_MORE}++"
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What a text must hold to be cut at all: a digit, an @, or a sign of a secret or a title.
_ANY = rf"[0-9@]|(?i:password|passwd|pwd|secret|api|token|access)|(?:{_TITLE})|MR"
#: Attempts in a format before a surrogate grows by a digit each: a format that is used up (one-digit numbers, say) must not be tried for ever.
IN_FORMAT = 8
#: Where the key is configured; without it the public default below is used, which hides nothing from who has this code.
KEY_SETTING, DEFAULT_KEY = "spark.meteoframe.surrogate.key", "surrogate-key-1"
#: Syllables by script; names are drawn from these.
SYLLABLES = {"latin": "ba be bo ca da de do fa fe ga go la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi vo".split(),
             "cyrillic": "ба бе бо ва ве да де до за ка ко ла ле ли ло ма ме ми мо на не ни но па по ра ре ри ро са се си со та те ти то".split(),
             "greek": "βα βε γα γο δα δε δο κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε σι σο τα τε τι το".split()}
ENDINGS = {"latin": {"m": "n", "f": "a", "n": "r"}, "cyrillic": {"m": "н", "f": "а", "n": "р"}, "greek": {"m": "ς", "f": "α", "n": "ρ"}}


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def mentions(text: Column | str) -> Column:
    """All matches in a text, in order."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike(_ANY), F.regexp_extract_all(c, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def kind(value: Column) -> Column:
    """The type of a match."""
    out = F.lit("other")
    for name, pattern in reversed(PATTERNS.items()):
        out = F.when(value.rlike(rf"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _byte(stream: Column, at: Column) -> Column:
    """Byte ``at`` of a hex stream of 256 bytes (later ones begin again)."""
    return F.conv(F.substring(stream, (at % 256) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _stream(key: str, *parts: Column) -> Column:
    seed = F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts])
    return F.concat(*[F.sha2(F.concat(seed, F.lit(f"\x1f{k}")), 256) for k in range(8)])


def _same_format(value: Column, stream: Column) -> Column:
    """``value`` with digits, lower and upper letters replaced by others of their class (hex by hex); the rest stays."""
    hexed = value.rlike("^[0-9a-f]{8,}[\"']?$")
    def char(c: Column, i: Column) -> Column:
        b = _byte(stream, i)
        pick = lambda letters: F.substring(F.lit(letters), b % len(letters) + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]") & hexed, pick("abcdef")).when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
                .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c))
    return F.array_join(F.transform(F.split(value, ""), char), "")


def _checked(value: Column) -> Column:
    """A card number with its last digit set so that the Luhn sum is a multiple of ten."""
    digits = F.split(F.regexp_replace(value, "[^0-9]", ""), "")
    body = F.reverse(F.slice(digits, F.lit(1), F.size(digits) - 1))
    doubled = F.transform(body, lambda d, i: F.when(i % 2 == 0, F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    check = F.pmod(-F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10))
    return F.concat(F.substring(value, F.lit(1), F.length(value) - 1), check.cast("string"))


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).when(value.rlike(r"\p{IsGreek}"), F.lit("greek")).otherwise(F.lit("latin"))


def _spoken(value: Column, gender: Column, stream: Column, attempt: Column) -> Column:
    """A capitalised name of the value's script, of two to four syllables and one more per attempt, with the gender's ending."""
    out = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        count = F.lit(2) + _byte(stream, F.lit(0)) % 3 + attempt
        made = F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.element_at(F.array(*map(F.lit, syllables)), _byte(stream, i) % len(syllables) + 1)), "")
        ending = F.coalesce(*[F.when(gender == g, F.lit(e)) for g, e in ENDINGS[script].items()], F.lit(""))
        out = F.when(_script(value) == script, F.initcap(F.concat(made, ending))).otherwise(out)
    return F.when((F.length(value) > 2) & (value == F.upper(value)), F.upper(out)).otherwise(out)


def _made(key: str) -> Column:
    """Surrogate of (type, value, gender, attempt)."""
    value, kind_, attempt = F.col("value"), F.col("type"), F.col("attempt")
    stream = _stream(key, kind_, value, attempt)
    octets = F.array_join(F.transform(F.split(value, r"\."), lambda o, i: (_byte(stream, i) % 254 + 1).cast("string")), ".")
    held = F.regexp_extract(value, r"^(.*?[=:]\s*[\"']?)(.*?)([\"']?)$", 1)
    rest = F.expr("substring(value, length(regexp_extract(value, '^(.*?[=:]\\\\s*[\"\\']?)', 1)) + 1)")
    grown = F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(attempt - IN_FORMAT, F.lit(1))), lambda i: (_byte(stream, i) % 10).cast("string")), "")
    made = (F.when(kind_ == "ip", octets).when(kind_ == "card", _checked(_same_format(value, stream)))
            .when(kind_ == "secret", F.concat(held, _same_format(rest, stream)))
            .when(kind_ == "key", F.concat(F.substring(value, 1, 4), _same_format(F.expr("substring(value, 5)"), stream)))
            .when(kind_ == "email", F.concat(_same_format(F.regexp_replace(value, r"\.[A-Za-z]+$", ""), stream), F.regexp_extract(value, r"\.[A-Za-z]+$", 0)))
            .when(kind_ == "iban", F.concat(F.substring(value, 1, 2), _same_format(F.expr("substring(value, 3)"), stream)))
            .when(kind_.isin("given", "last"), _spoken(value, F.col("gender"), stream, attempt))
            .otherwise(_same_format(value, stream)))
    return F.when((attempt > IN_FORMAT) & ~kind_.isin("given", "last"), F.concat(made, grown)).otherwise(made)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, gender, value, surrogate) of distinct (type, gender, value): no two surrogates are equal, and none is a value of the table, whatever the types.

    A clash leaves the surrogate with the entity of the earlier attempt, then of
    the lesser type and value; the others try again, and after ``IN_FORMAT``
    attempts with a digit more each time, so a format that is used up ends.
    """
    now = written(entities.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", _made(key)), "surrogates")
    while True:
        first = F.row_number().over(Window.partitionBy("surrogate").orderBy("attempt", "type", "value", "gender"))
        known = now.select(F.col("value").alias("_v")).distinct()
        marked = now.withColumn("nth", first).join(known, F.col("surrogate") == F.col("_v"), "left")
        marked = marked.withColumn("again", (F.col("nth") > 1) | F.col("_v").isNotNull())
        marked = written(marked.select("type", "gender", "value", "attempt", "surrogate", "again"), "clashes")
        if marked.filter("again").isEmpty():
            return now.select("type", "gender", "value", "surrogate")
        tried = marked.filter("again").withColumn("attempt", F.col("attempt") + 1).withColumn("surrogate", _made(key))
        now = written(marked.filter("not again").select(now.columns).union(tried.select(now.columns)), "surrogates")


def replaced(docs: DataFrame, key: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_entities): every row with its entities replaced by their surrogates.

    Null texts stay null and count 0; null ids and repeated rows come back like
    any other; other columns play no part. The same key gives the same surrogates; without
    ``key`` the session's ``KEY_SETTING`` names it.
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, DEFAULT_KEY)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = written(rows.withColumn("mentions", mentions("text")), "mentions")  # the patterns are searched once, and every row is written once
    none = found.filter(F.size("mentions") == 0).select("doc_id", "text", F.lit(0).alias("n_entities"))
    some = found.filter(F.size("mentions") > 0).withColumn("text_key", F.sha2("text", 256))
    per_text = written(some.select("text_key", F.explode(F.array_distinct("mentions")).alias("mention")).distinct(), "text-mentions")
    named = _named(per_text.select("mention").distinct(), key)
    maps = per_text.join(named, "mention").groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("mention", "surrogate"))).alias("by_mention"))
    cut = some.join(maps, "text_key").withColumn("gaps", F.split("text", PATTERN, -1))
    cut = cut.withColumn("full", F.filter(F.array_distinct("mentions"), lambda m: m.rlike(rf"^{_FULL}$")))
    named_gap = lambda g: F.aggregate("full", g, lambda text, m: F.regexp_replace(text, _untitled(m), _bare(F.element_at("by_mention", m))))
    cut = cut.withColumn("n_entities", F.size("mentions") + F.when(F.size("full") > 0, F.aggregate("gaps", F.lit(0), lambda n, g: n + _repeats(g))).otherwise(0))
    cut = cut.withColumn("gaps", F.when(F.size("full") > 0, F.transform("gaps", named_gap)).otherwise(F.col("gaps")))
    whole = F.expr("array_join(zip_with(gaps, transform(mentions, m -> element_at(by_mention, m)), (g, s) -> concat(g, coalesce(s, ''))), '')")
    return none.union(cut.select("doc_id", whole.alias("text"), "n_entities"))


def _bare(name: Column) -> Column:
    """A name without its title."""
    return F.regexp_replace(name, r"^\S+ ", "")


def _untitled(name: Column) -> Column:
    """Pattern of a titled full name where it stands without the title."""
    return F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), _bare(name), F.lit(r"\E(?![\p{L}\p{N}]|-\p{L})"))


def _repeats(gap: Column) -> Column:
    """How often the names in ``full`` stand in ``gap``."""
    return F.aggregate("full", F.lit(0), lambda n, m: n + F.size(F.split(gap, _untitled(m), -1)) - 1)


def _named(distinct: DataFrame, key: str) -> DataFrame:
    """(mention, surrogate) of distinct mentions."""
    gender = F.lit("n")
    for g, titles in TITLES.items():
        gender = F.when(F.col("mention").rlike(rf"^(?:{titles})\.? "), F.lit(g)).otherwise(gender)
    words = F.split("mention", " ")
    kinds = written(distinct.withColumn("type", kind(F.col("mention"))).withColumn("gender", F.when(F.col("type") == "name", gender).otherwise(F.lit("")))
                    .withColumn("last", F.when(F.col("type") == "name", F.element_at(words, -1)))
                    .withColumn("given", F.when((F.col("type") == "name") & (F.size(words) > 2), F.element_at(words, 2))), "kinds")
    plain = kinds.filter("type <> 'name'").select("type", "gender", F.col("mention").alias("value"))
    last = kinds.filter("last is not null").select(F.lit("last").alias("type"), F.lit("").alias("gender"), F.col("last").alias("value"))
    given = kinds.filter("given is not null").select(F.lit("given").alias("type"), "gender", F.col("given").alias("value"))
    made = written(surrogates(plain.union(last).union(given), key), "entities")
    of = lambda t, a: made.filter(F.col("type") == t).select(F.col("value").alias(a), F.col("gender").alias(f"{a}_gender"), F.col("surrogate").alias(f"{a}_new"))
    names = kinds.filter("type = 'name'").join(of("last", "last").drop("last_gender"), "last").join(
        of("given", "given").withColumnRenamed("given_gender", "gender"), ["given", "gender"], "left")
    spoken = names.select("mention", F.concat_ws(" ", F.element_at(F.split("mention", " "), 1), "given_new", "last_new").alias("surrogate"))
    return made.filter("type not in ('last', 'given')").select(F.col("value").alias("mention"), "surrogate").union(spoken)
