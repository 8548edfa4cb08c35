"""Surrogates for personal data: every entity gets one replacement of its own kind and form, everywhere the same."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.session import ensure_checkpoint_dir

# Forms of address, which tell a gender, in three scripts.
TITLES = {
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Госпожа Г-жа Κυρία Κα",
    "m": "Mr Sir Herr Monsieur Señor Sr Господин Г-н Κύριος Κος",
}
# Surrogate names: syllables, then an ending that tells gender and part of the name.
SOUNDS = {
    "latin": ("bdfgklmnprstvz", "aeiou"),
    "cyrillic": ("бвгдклмнпрстфз", "аеиоу"),
    "greek": ("βγδκλμνπρστφζχ", "αειοω"),
}
ENDINGS = {
    "latin given f": "la", "latin given m": "lon", "latin family f": "rick", "latin family m": "rick",
    "cyrillic given f": "ла", "cyrillic given m": "лан", "cyrillic family f": "рова", "cyrillic family m": "ров",
    "greek given f": "λα", "greek given m": "λος", "greek family f": "ρου", "greek family m": "ρης",
}
TITLE = "|".join(t for titles in TITLES.values() for t in titles.split())
# A capitalised word that is no form of address, without a possessive 's.
NAME = rf"(?!(?:{TITLE})(?!\p{{L}}))\p{{Lu}}[\p{{L}}'’-]*\p{{L}}(?<!['’][sS])"
SECRET = r"(?i:token|password|passwd|secret|key)"
# The first of these forms that fits at a place is taken.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": r"AKIA[0-9A-Z]{16}|(?<![0-9A-Za-z])[0-9a-f]{32,}(?![0-9A-Za-z])"
    rf"|(?<={SECRET}[\x22']?\s{{0,2}}[=:]\s{{0,2}}[\x22']?)" r"[^\s\x22'=:#$%&*,;|]{6,}",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![\d.])(?:\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{4}[ -]?\d{6}[ -]?\d{4,5})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\d)",
    "person": rf"(?<!\p{{L}})(?:{TITLE})\.? {NAME}(?: {NAME})*+",
}
ANY = "|".join(f"(?:{form})" for form in FORMS.values())
# A text without these has no entity; most texts are settled by this one look.
HINT = rf"[0-9@]|{SECRET}|(?<!\p{{L}})(?:{TITLE})\.? \p{{Lu}}"
# So often a surrogate is drawn. Few entities need a second draw, unless a form has hardly any free values left.
ROUNDS = 40
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def mentions_of(text: Column) -> Column:
    """All mentions of a text, in order."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def kind_of(mention: Column) -> Column:
    """The first form that a mention has as a whole; a secret is known by what stood before it."""
    kinds = F.lit(None)
    for name in reversed([k for k in FORMS if k != "secret"]):
        kinds = F.when(mention.rlike(f"^(?:{FORMS[name]})$"), name).otherwise(kinds)
    return F.coalesce(kinds, F.lit("secret"))


def names_of(mention: Column) -> Column:
    """The names in a mention of a person: all words after the form of address."""
    words = F.split(mention, " ")
    return F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))


def gender_of(mention: Column) -> Column:
    """What the form of address of a person tells."""
    female = mention.rlike(rf"^(?:{'|'.join(TITLES['f'].split())})(?!\p{{L}})")
    return F.when(female, "f").otherwise("m")


def parts_of(mention: Column, kind: Column) -> Column:
    """The entities in a mention: (kind, canon, made_of). A person's names are entities of their own, so a name is the same
    in full and after a title alone; its gender shows in the ending. ``canon`` is what all spellings of an entity share,
    ``made_of`` what tells how a surrogate is made."""
    names = names_of(mention)

    def name(word: Column, i: Column) -> Column:
        script = F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        role = F.when(i == F.size(names) - 1, "family").otherwise("given")
        return F.struct(
            F.lit("person").alias("kind"), F.lower(word).alias("canon"),
            F.concat_ws(" ", script, role).alias("made_of"),
        )

    digits = F.regexp_replace(mention, r"[^0-9]", "")
    canon = (
        F.when(kind.isin("card", "ssn"), digits)
        .when(kind == "phone", F.regexp_replace(mention, r"[^0-9+]", ""))
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .when(kind == "email", F.lower(mention))
        .otherwise(mention)
    )
    one = F.array(F.struct(kind.alias("kind"), canon.alias("canon"), kind.alias("made_of")))
    return F.when(kind == "person", F.transform(names, name)).otherwise(one)


def _luhn(digits: Column) -> Column:
    """The digit that makes a number valid when it follows ``digits``."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return ((10 - F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10) % 10).cast("string")


def _check_digits(iban: Column) -> Column:
    """The two digits after the country that make an IBAN valid, whatever stands there: 98 less the rest modulo 97 of the
    account, the country and 00, with letters as 10 to 35."""
    number = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.left(iban, F.lit(2)), F.lit("00"))

    def add(total: Column, i: Column) -> Column:
        c = F.substring(number, i + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), (total * 10 + c.cast("int")) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97)

    rest = F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def _of(values: dict[str, str], name: Column) -> Column:
    """The value of a name; null for others."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), name)


def with_candidates(entities: DataFrame, secret_key: str, attempt: int) -> DataFrame:
    """Add the surrogate of an attempt to kind, canon, made_of: a keyed hash of the entity, written in the entity's form.

    Digits become digits and letters letters of the same case, place by place; what else stands in it stays, and so do the
    last label of a mail domain, a country code, an issuer's first digit and IBAN country. A card or an IBAN that is valid
    gets valid check digits, and bare hex keeps its alphabet. The octets of addresses keep their lengths. Names get 2
    syllables and one more per attempt; their endings follow when they are put into a text.
    """
    kind, canon = F.col("kind"), F.col("canon")
    blocks = [F.sha2(F.concat_ws("|", F.lit(f"{secret_key}|{attempt}|{b}"), kind, canon), 256) for b in range(4)]
    rows = entities.withColumn("stream", F.concat(*blocks))  # 128 bytes in hex, a column of its own: hashed once
    kept = (
        F.when(kind == "email", F.length(F.substring_index(canon, ".", -1)) * -1)
        .when(kind == "phone", F.when(canon.startswith("+1"), 2).when(canon.startswith("+"), 3).otherwise(0))
        .when(kind == "iban", 2).when(kind == "card", 1)
        .when((kind == "secret") & canon.startswith("AKIA"), 4).otherwise(0)
    )
    rows = rows.withColumn("stays", kept).withColumn("hexadecimal", (kind == "secret") & canon.rlike("^[0-9a-f]+$"))

    def byte(i: Column) -> Column:
        return F.conv(F.substring("stream", (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def place(i: Column) -> Column:
        c = F.substring(canon, i + 1, F.lit(1))
        letter = F.substring(F.lit(LETTERS), byte(i) % 26 + 1, F.lit(1))
        fresh = (
            F.when(F.col("hexadecimal"), F.substring("stream", (i % 128) * 2 + 1, F.lit(1)))
            .when(c.rlike("[0-9]"), (byte(i) % 10).cast("string"))
            .when(c.rlike("[a-z]"), letter).when(c.rlike("[A-Z]"), F.upper(letter)).otherwise(c)
        )
        stays = (i < F.col("stays")) | ((F.col("stays") < 0) & (i >= F.length(canon) + F.col("stays")))
        return F.when(stays, c).otherwise(fresh)

    def octet(part: Column, i: Column) -> Column:
        b, n = byte(i), F.length(part)
        return F.when(n == 1, b % 9 + 1).when(n == 2, b % 90 + 10).otherwise(b % 155 + 100).cast("string")

    script = F.substring_index("made_of", " ", 1)
    consonants, vowels = ({s: sounds[k] for s, sounds in SOUNDS.items()} for k in (0, 1))

    def sound(i: Column) -> Column:
        of = F.when(i % 2 == 0, _of(consonants, script)).otherwise(_of(vowels, script))
        return F.substring(of, byte(i) % F.length(of) + 1, F.lit(1))

    spelled = F.transform(F.sequence(F.lit(0), F.length(canon) - 1), place)
    sounds = F.transform(F.sequence(F.lit(0), F.lit(2 * (2 + attempt) - 1)), sound)
    made = (
        F.when(kind == "ip", F.array_join(F.transform(F.split(canon, "[.]"), octet), "."))
        .when(kind == "person", F.array_join(sounds, ""))
        .otherwise(F.array_join(spelled, ""))
    )
    body = F.left("made", F.length("made") - 1)
    valid = (kind == "card") & (_luhn(F.left(canon, F.length(canon) - 1)) == F.substring(canon, -1, 1))
    checked = (kind == "iban") & (_check_digits(canon) == F.substring(canon, 3, 2))
    country, account = F.left("made", F.lit(2)), F.substring(F.col("made"), F.lit(5), F.length("made"))
    surrogate = F.when(valid, F.concat(body, _luhn(body))).otherwise(F.col("made"))
    surrogate = F.when(checked, F.concat(country, _check_digits(F.col("made")), account)).otherwise(surrogate)
    return rows.withColumn("made", made).withColumn("surrogate", surrogate).drop("stream", "stays", "hexadecimal", "made")


def assign(entities: DataFrame, secret_key: str, rounds: int = ROUNDS) -> DataFrame:
    """kind, canon, made_of, surrogate: a surrogate for each different entity, no two alike, none of them an entity of the
    corpus. A name that is a given name anywhere is one everywhere. A person's surrogate is the stem of a name; a stem is
    no good if it makes a name of the corpus with any ending.

    In each round the entities that are left make a candidate. One that is itself an entity, or was given away before, is
    no good; of several entities with one candidate the first keeps it. Few are left after a round, and the rounds end when
    none is. What is left after ``rounds`` draws (a form has hardly any free values then, or none) gets its SHA-256 in place
    of a form. Every round is checkpointed, so each reads the one before as a table.
    """
    ensure_checkpoint_dir(entities.sparkSession)
    left = entities.groupBy("kind", "canon").agg(F.max("made_of").alias("made_of")).checkpoint()
    canon = F.col("canon")
    stems = F.array(canon, *[F.when(canon.endswith(e), F.expr(f"left(canon, length(canon) - {len(e)})")) for e in sorted(set(ENDINGS.values()))])
    stems = F.when(F.col("kind") == "person", F.array_compact(stems)).otherwise(F.array(canon))
    taken = left.select("kind", F.explode(stems).alias("surrogate"))
    given = []
    for attempt in range(rounds):
        tried = with_candidates(left, secret_key, attempt)
        first = tried.groupBy("kind", "surrogate").agg(F.min(F.struct("canon", "made_of")).alias("first"))
        free = first.join(taken, ["kind", "surrogate"], "left_anti")
        won = free.select("kind", "first.canon", "first.made_of", "surrogate").checkpoint()
        given.append(won)
        taken = taken.unionByName(won.select("kind", "surrogate"))
        left = left.join(won, ["kind", "canon"], "left_anti").checkpoint()
        if left.isEmpty():
            break
    beyond = F.sha2(F.concat_ws("|", F.lit(secret_key), "kind", "canon"), 256).alias("surrogate")
    return reduce(DataFrame.unionByName, [*given, left.select("kind", "canon", "made_of", beyond)])


def named(word: Column, surrogate: Column) -> Column:
    """The surrogate of a name in the case of the word."""
    return F.when(word == F.upper(word), F.upper(surrogate)).otherwise(F.initcap(surrogate))


def renamed(text: Column, names: Column, pattern: Column) -> Column:
    """A stretch between mentions, with the names that the text's mentions hold replaced there as well."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    put = F.transform(found, lambda word: named(word, F.element_at(names, F.lower(word))))
    pairs = F.zip_with(F.split(text, pattern, -1), F.zip_with(found, put, lambda a, b: F.coalesce(b, a)), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(F.size(names) > 0, F.array_join(pairs, "")).otherwise(text)


def rendered(mention: Column, kind: Column, surrogates: Column) -> Column:
    """The surrogate in the mention's spelling: its separators and its upper case."""
    surrogate = F.get(surrogates, F.lit(0))
    chars = F.split(mention, "")

    def fill(pattern: str) -> Column:
        def place(c: Column, i: Column) -> Column:
            before = F.length(F.regexp_replace(F.left(mention, i), pattern, ""))
            return F.when(c.rlike(pattern), c).otherwise(F.substring(surrogate, before + 1, F.lit(1)))

        return F.array_join(F.transform(chars, place), "")

    def cased(c: Column, i: Column) -> Column:
        s = F.substring(surrogate, i + 1, F.lit(1))
        return F.when(c.rlike("[A-Z]"), F.upper(s)).otherwise(s)

    spelled = (
        F.when(kind.isin("card", "ssn"), fill("[^0-9]"))
        .when(kind == "phone", fill("[^0-9+]"))
        .when(kind == "iban", fill(" "))
        .when(kind == "email", F.array_join(F.transform(chars, cased), ""))
        .otherwise(surrogate)
    )
    put = F.transform(names_of(mention), lambda word, i: named(word, F.get(surrogates, i)))
    person = F.concat_ws(" ", F.substring_index(mention, " ", 1), put)
    beyond = F.length(surrogate) == 64  # an entity whose form was used up
    return F.when(kind == "person", person).when(beyond & (kind != "secret"), surrogate).otherwise(spelled)


def replacements(texts: DataFrame, secret_key: str) -> DataFrame:
    """key, swaps (mention -> its rendered surrogate), names (a person's name in lower case -> its surrogate) and the
    pattern of these names, for texts (key, text); one row per key with a mention.

    Mentions are taken once per text and form a table of their own; a text's swaps are bounded by its own mentions.
    """
    ensure_checkpoint_dir(texts.sparkSession)
    kind = kind_of(F.col("mention"))
    mentions = (
        texts.select("key", F.explode(F.array_distinct(mentions_of(F.col("text")))).alias("mention"))
        .distinct()
        .withColumn("kind", kind)
        .withColumn("parts", parts_of(F.col("mention"), F.col("kind")))
        .checkpoint()
    )
    every = mentions.select(F.posexplode("parts").alias("place", "part"), "key", "mention", F.col("kind").alias("form"))
    every = every.select("key", "mention", "form", "place", "part.kind", "part.canon", "part.made_of")
    surrogates = assign(every.select("kind", "canon", "made_of"), secret_key).checkpoint()
    ending = _of(ENDINGS, F.concat_ws(" ", "made_of", gender_of(F.col("mention"))))
    ended = F.when(F.col("kind") == "person", F.concat("surrogate", ending)).otherwise(F.col("surrogate"))
    put = every.drop("made_of").join(surrogates, ["kind", "canon"]).withColumn("surrogate", ended)
    spelled = (
        put.groupBy("key", "mention", "form")
        .agg(F.sort_array(F.collect_list(F.struct("place", "surrogate")))["surrogate"].alias("surrogates"))
        .withColumn("swap", rendered(F.col("mention"), F.col("form"), F.col("surrogates")))
    )
    # Without a title a name has no gender; if the text has it for both, the feminine form stands for it.
    names = put.filter("kind = 'person'").groupBy("key", F.col("canon").alias("name"))
    names = names.agg(F.min(F.struct(gender_of(F.col("mention")).alias("gender"), "surrogate"))["surrogate"].alias("to"))
    names = names.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("name", "to"))).alias("names"))
    swaps = spelled.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("mention", "swap"))).alias("swaps"))
    none = F.create_map().cast("map<string,string>")
    grouped = swaps.join(names, "key", "left").withColumn("names", F.coalesce("names", none))
    # Names hold nothing but letters, apostrophes and hyphens; longer ones are tried first.
    longest = F.transform(F.map_keys("names"), lambda n: F.struct((-F.length(n)).alias("n"), n.alias("name")))
    one_of = F.array_join(F.transform(F.sort_array(longest), lambda x: x["name"]), "|")
    pattern = F.concat(F.lit(r"(?<!\p{L})(?=\p{Lu})(?iu:"), one_of, F.lit(r")(?!\p{L})"))
    return grouped.withColumn("pattern", pattern)


def replace_entities(docs: DataFrame, secret_key: str, column: str = "text") -> DataFrame:
    """The same rows and columns, with every entity in ``column`` replaced by its surrogate; an entity has one surrogate in
    all rows, different entities have different ones. Whoever knows ``secret_key`` can test guesses, so it is to be kept
    secret. The names of a person that was found by its form of address are
    replaced wherever the same text has them capitalised.

    Rows without an entity are passed on as they are, unshuffled. The others find their swaps by the SHA-256 of the text, so
    copies share them and nothing depends on ids. Null text stays null, and other columns are not touched, whatever their
    names: a row travels as one struct.
    """
    rows = docs.select(F.struct("*").alias("row"), docs[column].alias("text"))
    rows = rows.withColumn("mentions", mentions_of(F.col("text")))
    clean = rows.filter("text IS NULL OR size(mentions) = 0").select("row")
    dirty = rows.filter("size(mentions) > 0").withColumn("key", F.sha2("text", 256))
    # A table of its own, so that a text with very many copies can be split in the join.
    swaps = replacements(dirty.select("key", "text"), secret_key).withColumnRenamed("key", "its_key").checkpoint()
    between = F.split(F.col("text"), ANY, -1)
    between = F.transform(between, lambda part: renamed(part, F.col("names"), F.col("pattern")))
    put = F.transform(F.col("mentions"), lambda m: F.element_at("swaps", m))
    pairs = F.zip_with(between, put, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    joined = dirty.join(swaps, F.col("key") == F.col("its_key"))
    replaced = joined.select(F.col("row").withField(column, F.array_join(pairs, "")).alias("row"))
    return replaced.unionByName(clean).select("row.*")


def session_key(spark: SparkSession) -> str:
    """The key that the session names in ``spark.ladle.surrogates.key``. Without one, for trials and synthetic tables only,
    a fixed key that is no secret."""
    return spark.conf.get("spark.ladle.surrogates.key", "no secret: for trials only")


def surrogate_documents(docs: DataFrame, secret_key: str) -> DataFrame:
    """doc_id and the text with surrogates; null text stays null, and no row is lost or added."""
    return replace_entities(docs.select("doc_id", "text"), secret_key)
