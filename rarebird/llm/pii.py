"""Surrogates for personal data, with DataFrame functions only.

Detected entities are replaced by keyed surrogates of the same type and format: digits stay digits
in the same punctuation, letters stay letters of the same case, hexadecimal stays hexadecimal,
addresses stay valid, and names get names of the same gender (told by their title) and script. An
entity's canonical form (digits only, or lower case) decides its surrogate, so every mention in the
corpus, however it is punctuated, changes alike (coreference). Collision checks give every distinct
entity a surrogate of its own that is no entity of the corpus either: whoever clashes draws again
with the next attempt number, until nobody does (distinctness). From the ``WIDEN_AFTER``-th attempt on
surrogates grow with every attempt (an IPv4 address becomes an IPv6 one), so that a type with
few values (``x@y.co``) never runs out and the drawing ends for any corpus.

No pattern has an upper bound below what its type allows: keys, hexadecimal strings, phone numbers
and runs of names go to their end. Initials get a made name with the point (26 letters would not be
enough for distinct ones).

Only texts that hold an entity are shuffled, keyed by a digest of the text, so that copies are
worked on once; the others pass through a narrow stage.

Edge cases: a null text stays null; empty texts stay empty; entities in very long texts are all
replaced; repeated rows give equal texts; an empty table gives an empty result; every other column
is carried unchanged, and the working columns are named so that they do not clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarebird.llm.common import Scratch

#: courtesy titles by gender
MALE = ["Mr", "Herr", "Señor", "Monsieur", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа", "Κυρία"]
NEUTRAL = ["Dr", "Prof", "Mx"]
#: types of names, by what their title tells
NAMED = ["male", "female", "neutral"]
#: attempts with surrogates of the entity's own length
WIDEN_AFTER = 4

_TITLES = {"male": "|".join(MALE), "female": "|".join(FEMALE), "neutral": "|".join(NEUTRAL)}
_ANY_TITLE = "|".join(_TITLES.values())
#: what parts a title from a name: a point, and white space of any kind
_GAP = "\\.?[\\s\\u00a0\\u202f]{1,8}"
_INITIALS = "(?:\\p{Lu}\\.-?)"
#: a capitalised name, also with initials before it, or initials alone
_NAME = f"(?:{_INITIALS}*+\\p{{Lu}}(?:[\\p{{L}}\\-]|['’](?=\\p{{Lu}}))*+|{_INITIALS}++)"

#: (type, pattern) in order of precedence; where several match at a place, the first one counts
ENTITIES = [
    # a domain has at most 127 labels; a hyphen is part of it only between letters or digits
    ("email", "(?<![\\p{L}0-9._%+\\-])[\\p{L}0-9._%+\\-]++@(?:[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+\\.){1,126}[A-Za-z]{2,63}+(?![A-Za-z0-9])"),
    ("hex", "(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])"),
    ("key", "(?<![0-9A-Za-z_\\-])(?:AKIA[0-9A-Z]{16}|sk[_\\-][0-9A-Za-z_\\-]{16,}+|gh[pousr]_[0-9A-Za-z]{30,}+)(?![0-9A-Za-z_\\-])"),
    ("iban", "(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[ ]?[0-9A-Z]{4}){3,7}(?:[ ]?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"),
    ("ssn", "(?<![0-9\\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\\-])"),
    ("ip", "(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\\.[0-9])"),
    ("phone", "(?<![0-9A-Za-z+])(?:\\+[0-9]{1,3}[ .\\-]?(?:\\([0-9]{1,4}\\)|[0-9]{1,4})(?:[ .\\-]?[0-9]{2,4}){2}"
     "(?:[ .\\-]?[0-9]{2,}+|-[0-9](?![0-9]))*+"
     "|\\([0-9]{3}\\)[ ]?[0-9]{3}[ .\\-][0-9]{4}|[0-9]{3}[.\\-][0-9]{3}[.\\-][0-9]{4})(?![0-9])"),
    ("card", "(?<![0-9A-Za-z.])[0-9]{4}(?:[ \\-]?[0-9]{4}){2}[ \\-]?[0-9]{1,7}(?![0-9A-Za-z])"),
]
#: all capitalised names and initials right after a courtesy title; the title stays
_AFTER_TITLE = f"(?<=(?<!\\p{{L}})(?:{_ANY_TITLE}){_GAP}){_NAME}(?:[ ]{_NAME})*(?![\\p{{L}}@])"
ANY = "|".join([f"(?:{p})" for _, p in ENTITIES] + [_AFTER_TITLE])
#: a text without any of these holds no entity: each pattern above cannot match without the part named after it
HINT = "|".join([
    "@",  # email
    "[0-9A-Fa-f]{32}",  # hex
    "AKIA|sk[_\\-]|gh[pousr]_",  # key
    "[A-Z]{2}[0-9]{2}",  # iban
    "[0-9]{3}",  # ssn, card, phone without a country
    "[0-9]\\.[0-9]",  # ip
    "\\+[0-9]",  # phone
    f"(?:{_ANY_TITLE}){_GAP}",  # names
])
DIGIT_TYPES = ["ssn", "phone", "card"]
KEEP_FIRST = ["phone", "card"]

#: syllables and endings from which surrogate names are built, by script
SYLLABLES = {
    "Latin": ("ba be bi bo da de di do fa fe fi fo ga ge gi go ka ke ki ko la le li lo ma me mi mo na ne ni no",
              {"male": "n r s t", "female": "a ia ina ela", "neutral": "l m x z"}),
    "Cyrillic": ("ба бе би бо да де ди до ва ве ви во га ге ги го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но",
                 {"male": "н р с т", "female": "а ия ина ела", "neutral": "л м х з"}),
    "Greek": ("βα βε βι βο δα δε δι δο φα φε φι φο γα γε γι γο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο",
              {"male": "νος ρος σης της", "female": "α ια ινα ελα", "neutral": "λι μι ξι ζι"}),
}


def _marked(docs: DataFrame, text: str) -> DataFrame:
    """Adds ``__pii_parts``: plain text at even places, entities at odd ones (null for a null text)."""
    body, fence = F.col("__pii_text"), F.col("__pii_fence")
    # a separator that no text holds: letters made of the text's own digest between control characters
    digest = F.translate(F.substring(F.md5(body.cast("binary")), 1, 20), "0123456789", "ghijklmnop")
    out = docs.withColumn("__pii_text", F.col(f"`{text}`").cast("string"))
    out = out.withColumn("__pii_fence", F.concat(F.lit("\x01"), digest, F.lit("\x02")))
    marked = F.regexp_replace(body, F.lit(ANY), F.concat(fence, F.lit("$0"), fence))
    return out.withColumn("__pii_parts", F.when(body.rlike(HINT), F.split(marked, fence)).otherwise(F.array(body))).drop(
        "__pii_text", "__pii_fence")


def _kind(value: Column, before: Column) -> Column:
    """The type of an entity; a name's gender is that of the title that ends the text before it."""
    chain = None
    for kind, pattern in ENTITIES:
        fits = value.rlike(f"^(?:{pattern})$")
        chain = F.when(fits, kind) if chain is None else chain.when(fits, kind)
    for kind in ("female", "neutral"):
        chain = chain.when(F.right(before, F.lit(24)).rlike(f"(?<!\\p{{L}})(?:{_TITLES[kind]}){_GAP}$"), kind)
    return chain.otherwise("male")


def canonical(kind: Column, value: Column) -> Column:
    return F.when(kind.isin(DIGIT_TYPES), F.regexp_replace(value, "[^0-9]", "")).when(
        kind.isin("key"), value).when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).when(
        kind.isin(NAMED), F.regexp_replace(F.lower(value), "\\.-?$", "")).otherwise(F.lower(value))


def script(value: Column) -> Column:
    return F.when(value.rlike("\\p{IsCyrillic}"), "Cyrillic").when(value.rlike("\\p{IsGreek}"), "Greek").otherwise("Latin")


def surrogate(kind: Column, value: Column, key: str, attempt: Column) -> Column:
    """The surrogate of a canonical value: drawn from a keyed hash of type, value and attempt."""
    draw = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 512)
    byte = lambda i: F.conv(F.substring(draw, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
    pick = lambda alphabet, i: F.substring(F.lit(alphabet), byte(i) % len(alphabet) + 1, F.lit(1))
    digits, lower, upper, hexa = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
    top = F.length(F.regexp_extract(value, "\\.[a-z]+$", 0))  # an address keeps its top-level domain
    prefix = F.length(F.regexp_extract(value, "^(?:AKIA|sk[_\\-]|gh[pousr]_)", 0))

    def char(c: Column, i: Column) -> Column:
        fixed = (kind.isin(KEEP_FIRST) & (i == 0)) | ((kind == "email") & (i >= F.length(value) - top)) | (
            (kind == "key") & (i < prefix)) | ((kind == "iban") & (i < 2))
        return (F.when(fixed, c).when((kind == "hex") & c.rlike("[0-9a-f]"), pick(hexa, i))
                .when(c.rlike("[0-9]"), pick(digits, i)).when(c.rlike("[a-z]"), pick(lower, i))
                .when(c.rlike("[A-Z]"), pick(upper, i)).when(c.rlike("\\p{L}"), pick(lower, i)).otherwise(c))

    same_shape = F.array_join(F.transform(F.split(value, ""), char), "")
    # further characters for the later attempts
    more = F.greatest(attempt - WIDEN_AFTER + 1, F.lit(0))
    extra = lambda pick_at: F.array_join(F.transform(F.slice(F.sequence(F.lit(0), more), F.lit(1), more), pick_at), "")
    added = extra(lambda i: F.when(kind == "email", pick(lower, i + 31)).when(kind == "hex", pick(hexa, i + 31)).otherwise(pick(digits, i + 31)))
    same_shape = F.when(kind == "email", F.concat(added, same_shape)).otherwise(F.concat(same_shape, added))
    octets_6 = F.concat(F.lit("2001:db8"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.concat(
        F.lit(":"), *[pick(hexa, 4 * i + k) for k in range(4)])), ""))
    octets = F.concat_ws(".", *[(byte(F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    names = None
    for name, (syllables, endings) in SYLLABLES.items():
        parts = F.array(*map(F.lit, syllables.split()))
        for gender, tails in endings.items():
            end = F.array(*map(F.lit, tails.split()))
            made = F.concat(*[F.get(parts, byte(F.lit(i)) % 32) for i in range(4)], F.get(end, byte(F.lit(9)) % 4))
            # further attempts use further syllables, so that names never run out
            made = F.concat(made, extra(lambda i: F.get(parts, byte(i + 11) % 32)))  # noqa: B023
            fits = (kind == gender) & (script(value) == name)
            names = F.when(fits, made) if names is None else names.when(fits, made)
    return F.when(kind == "ip", F.when(more > 0, octets_6).otherwise(octets)).when(kind.isin(NAMED), names).otherwise(same_shape)


def dress(kind: Column, value: Column, canon: Column) -> Column:
    """The canonical surrogate in the format of the mention ``value``."""
    rank = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i + 1), "[^0-9]", ""))
    digits = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(canon, rank(i), F.lit(1))).otherwise(c)), "")
    # a widened surrogate is longer than the mention: the rest follows
    rest = lambda n: F.substring(canon, n + 1, F.length(canon))
    digits = F.concat(digits, rest(F.length(F.regexp_replace(value, "[^0-9]", ""))))
    letters = lambda i: F.length(F.replace(F.substring(value, F.lit(1), i + 1), F.lit(" "), F.lit("")))
    spaced = F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(
        c == " ", c).otherwise(F.substring(canon, letters(i), F.lit(1)))), "")
    spaced = F.concat(spaced, rest(F.length(F.replace(value, F.lit(" "), F.lit("")))))
    named = kind.isin(NAMED)
    shouted = (F.upper(value) == value) & (F.lower(value) != value) & ~(named & value.rlike(f"^{_INITIALS}*\\p{{L}}?$"))
    cased = F.when(shouted, F.upper(canon)).otherwise(F.when(named, F.initcap(canon)).otherwise(canon))
    cased = F.concat(cased, F.when(named, F.regexp_extract(value, "\\.-?$", 0)).otherwise(""))  # initials stay abbreviated
    return (F.when(kind.isin(DIGIT_TYPES), digits).when(kind == "iban", spaced)
            .when(kind.isin("key"), canon).otherwise(cased))


def surrogate_table(entities: DataFrame, key: str, scratch: Scratch, draw=surrogate) -> DataFrame:
    """(kind, value, surrogate) of distinct (kind, value): a surrogate each, none of them an entity."""
    everyone = scratch.keep(entities, "entities")
    left, done, k = everyone.withColumn("attempt", F.lit(0)), None, 0
    while True:
        drawn = left.withColumn("surrogate", draw(F.col("kind"), F.col("value"), key, F.col("attempt")))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("first"))
        taken = everyone.select("kind", F.col("value").alias("surrogate"))
        if done is not None:
            taken = taken.union(done.select("kind", "surrogate"))
        tried = drawn.join(first, ["kind", "surrogate"]).join(
            taken.distinct().withColumn("taken", F.lit(True)), ["kind", "surrogate"], "left")
        tried = scratch.keep(tried.select("kind", "value", "attempt", "surrogate", (
            (F.col("value") == F.col("first")) & F.col("taken").isNull()).alias("good")), f"drawn-{k}")
        good = tried.where("good").select("kind", "value", "surrogate")
        done = good if done is None else done.union(good)
        left = tried.where("not good").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        k += 1
        if left.isEmpty():
            return done


def replace_pii(docs: DataFrame, key: str = "surrogates", text: str = "text", count_into: str | None = None) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced; ``count_into`` adds their number (long)."""
    scratch = Scratch(docs.sparkSession)
    names = [f"`{c}`" for c in docs.columns]
    count = [] if count_into is None else [F.lit(0).cast("long").alias(count_into)]
    marked = _marked(docs, text)
    found = F.size("__pii_parts") > 1
    held = scratch.keep(marked.where(found).withColumn(
        "__pii_id", F.md5(F.array_join("__pii_parts", "\x01").cast("binary"))), "held")
    clean = marked.where(~found).select(*names, *count)

    # one line per mention (per name of it) in each distinct text
    parts = F.col("__pii_parts")
    odd = F.filter(F.transform(parts, lambda p, i: F.struct(p.alias("v"), _kind(p, F.get(parts, i - 1)).alias("kind"), i.alias("i"))),
                   lambda x: x["i"] % 2 == 1)
    each = held.select("__pii_id", "__pii_parts").dropDuplicates(["__pii_id"]).select("__pii_id", F.explode(odd).alias("m"))
    named = F.col("m.kind").isin(NAMED)
    mentions = each.select("__pii_id", "m.i", "m.kind", F.posexplode(
        F.when(named, F.split("m.v", " ")).otherwise(F.array("m.v"))).alias("j", "v"))
    mentions = mentions.withColumn("value", canonical(F.col("kind"), F.col("v")))
    mapped = surrogate_table(mentions.select("kind", "value").distinct(), key, scratch)
    dressed = mentions.join(mapped, ["kind", "value"]).select(
        "__pii_id", "i", F.struct("j", dress(F.col("kind"), F.col("v"), F.col("surrogate")).alias("s")).alias("m"))
    said = dressed.groupBy("__pii_id", "i").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("m")), lambda m: m["s"]), " ").alias("s"))
    new = said.groupBy("__pii_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda m: m["s"]).alias("__pii_new"))
    whole = F.array_join(F.transform("__pii_parts", lambda p, i: F.when(
        i % 2 == 1, F.get("__pii_new", F.floor(i / 2).cast("int"))).otherwise(p)), "")
    changed = held.join(new, "__pii_id").withColumn("__pii_whole", whole)
    out = [F.col("__pii_whole").cast(docs.schema[text].dataType).alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    count = [] if count_into is None else [F.size("__pii_new").cast("long").alias(count_into)]
    return changed.select(*out, *count).unionByName(clean)
