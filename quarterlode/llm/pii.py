r"""Surrogates for personal data and secrets, by DataFrame functions only.

One pattern finds mail addresses, telephone numbers, IPv4 addresses, payment cards,
social security and bank account numbers, access keys, passwords and tokens, and names
behind a title. Each entity becomes one or more *units* (kind and normal form); a unit
gets a surrogate from a keyed hash, so the same unit has the same surrogate in all texts.
Surrogates keep type and format: digits stay digits and letters stay letters of their
script, a card number stays valid, a hex string stays hex, a name keeps script, case and
the gender of its title. Two units never share a surrogate, and no surrogate is a unit
that occurs: units that clash are hashed again until none does. A unit that finds no free
surrogate of its own length in a few rounds gets a longer one, a character more with each
round, so that the rounds end however full a format is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlode.session import materialise

OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
SECRET_NAME = r"(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\s{0,3}"
SECRET_WORDS = SECRET_NAME + r"[=:]{1,3}\s{0,3}[\x22\x27]?"
# Between quotes all counts; after an equals sign any bare value; after a colon, where prose may follow, eight characters or a mixed word.
SECRET_END = r"(?<![.,;:)\]}#*|])"
SECRETS = SECRET_NAME + "(?:" + "|".join((
    *(rf"[=:]{{1,3}}\s{{0,3}}{q}(?=[^{q}\r\n]*[\p{{L}}\p{{N}}])[^{q}\r\n]++(?={q})" for q in (r"\x22", r"\x27")),
    r":?={1,3}\s{0,3}[\x22\x27]?(?=[^\s\x22\x27]*[\p{L}\p{N}])[^\s\x22\x27]+" + SECRET_END,
    r":\s{0,3}[\x22\x27]?(?:(?=\p{L}*[^\s\p{L}\x22\x27.,;:)\]}#*|])[^\s\x22\x27]{4,}|[^\s\x22\x27]{8,})" + SECRET_END,
)) + ")"
MALE, FEMALE = "Mr|Herr|Señor|Monsieur|Г-н", "Mrs|Ms|Miss|Frau|Señora|Madame|Г-жа"
NEUTRAL = "Dr|Prof"
TITLE = rf"(?:(?:{MALE}|{FEMALE}|{NEUTRAL})\.? )+"
NAME = rf"(?<!\p{{L}}){TITLE}\p{{Lu}}\p{{L}}++(?:[ \-]\p{{Lu}}\p{{L}}++)*+"
NAME_KINDS = ("family", "male", "female", "given")
# Lengths of account numbers by country; printed in groups of four, only the length tells where one ends.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR",
    27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU"}
SPACED_IBAN = rf"(?<![A-Z0-9])(?=[A-Z]{{2}}\d{{2}} )(?:" + "|".join(
    rf"(?:{c})\d{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items()) + r")(?![A-Za-z0-9])"
# Each alternative starts where its character class starts, so no text is scanned more than once for it; the first
# character is tested before what stands behind it, as most places fail there.
# A text's own card numbers stand between HEAD and TAIL, see _cards.
HEAD = "|".join((
    r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++",
    r"\+\d{1,3}[ .\-]?\(?\d{1,4}\)?[ .\-]?\d{3,4}[ .\-]?\d{3,4}(?!\d)",
    r"\+\d{1,3}[ .\-](?:\(0\)[ .\-]?)?(?:\d(?:[ .\-]\d{2}){4}|\d{2,3}(?:[ .\-]\d{2}){3}|\d{2}[ .\-]\d{3}(?:[ .\-]\d{2}){2})(?!\d)",
    rf"(?=\d)(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
))
SECURITY_NUMBER = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
PHONE = r"(?<![\d.\-])(?:\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}|\(?\d{3}\)?[ .\-]\d{3}[ .\-]\d{4})(?!\d)"
TAIL = "|".join((
    rf"(?=[\d(])(?:{SECURITY_NUMBER}|{PHONE})",
    r"(?=[A-Z])(?<![A-Z0-9])(?:AKIA[A-Z0-9]{16}(?![A-Z0-9])|[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])|" + SPACED_IBAN + ")",
    rf"(?=[APSTapst])(?<![A-Za-z])(?:{SECRETS})", "(?=[DFHMPSГ])" + NAME,
))
# Digits of card length in the groups that cards show, from any digit that starts a group; and whole runs of such digits.
GROUPED = r"(?<!\d)(?=(\d{13,19}(?!\d)|\d{4}(?:[ \-]\d{4}){3}(?!\d)|\d{4}[ \-]\d{6}[ \-]\d{4,5}(?!\d)))"
RUN = r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)"
CARD_START = r"(?=\d)(?<!\d)\d(?:[ \-]?\d){12}"
# Rounds in which a unit that clashes keeps its length, and syllables of a name.
PATIENCE = 4
SYLLABLES = 4
SCRIPTS = (("Cyrillic", "бвгдзклмнпрст", "аеиоу"), ("Greek", "βγδκλμνπρστ", "αειου"), ("Latin", "bdfgklmnprstv", "aeiou"))


def _q(text: str) -> str:
    """SQL literal that keeps backslashes."""
    return "r'" + text + "'"


def _luhn(digits: str) -> str:
    """SQL: Luhn sum of a digit string modulo 10."""
    chars = f"filter(split(reverse({digits}), ''), c -> c <> '')"
    doubled = f"transform({chars}, (c, i) -> if(i % 2 = 1, int(c) * 2 - if(int(c) > 4, 9, 0), int(c)))"
    return f"aggregate({doubled}, 0, (a, x) -> a + x) % 10"


def _with_cards(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """``docs`` with the valid card numbers of their texts: those in groups, and whole runs that hold neither such a card nor a shorter entity."""
    def found(pattern: str, group: int) -> Column:
        return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))

    digits = r"regexp_replace(v, r'\D', '')"
    docs = docs.withColumns({name: found(GROUPED, 1), name + "_": found(RUN, 0)})
    docs = docs.withColumns({c: F.expr(f"filter({c}, v -> {_luhn(digits)} = 0)") for c in (name, name + "_")})
    whole = F.expr(f"filter({name}_, v -> NOT v rlike {_q(SECURITY_NUMBER + '|' + PHONE)} AND NOT exists({name}, g -> contains(v, g)))")
    return docs.withColumn(name, F.array_union(name, whole)).drop(name + "_")


def _name_words(e: str) -> str:
    """SQL: the words of a name with its titles, as array of (kind, lead, shown)."""
    words = rf"split(regexp_replace({e}, r'^{TITLE}', ''), '(?<=[ -])')"
    title = f"regexp_extract({e}, r'^{TITLE}', 0)"
    gender = (rf"CASE WHEN {title} rlike r'(?<!\p{{L}})(?:{FEMALE})(?!\p{{L}})' THEN 'female' WHEN {title} rlike r'(?<!\p{{L}})(?:{MALE})(?!\p{{L}})' THEN 'male' "
              "ELSE 'given' END")
    # of several words the last is the family name; a word ends with the mark that joins it to the next
    return (f"transform({words}, (w, i) -> named_struct('kind', if(i = size({words}) - 1, 'family', {gender}), "
            f"'lead', if(i = 0, {title}, substr(element_at({words}, i), -1)), 'shown', regexp_replace(w, '[ -]$', '')))")


def _pattern(cards: Column, names: Column) -> Column:
    """The pattern of one text: with its own cards, and with the words of its titled names, which may stand without a title, too."""
    own = F.concat(F.lit(r"|(?<!\d)(?=\d)(?:"), F.array_join(cards, "|"), F.lit(r")(?!\d)"))
    again = F.concat(F.lit(r"|(?<!\p{L})(?=\p{Lu})(?:"), F.array_join(F.array_distinct(F.transform(names, lambda n: n["word"])), "|"), F.lit(r")(?!\p{L})"))
    return F.concat(F.lit(HEAD), F.when(F.size(cards) > 0, own).otherwise(""), F.lit("|" + TAIL), F.when(F.size(names) > 0, again).otherwise(""))


def _parts(names: str) -> str:
    """SQL: the units of entity ``e``, as array of (kind, lead, shown): text that stays, text that is replaced. ``names`` are its text's."""
    digits = r"regexp_replace(e, r'\D', '')"
    one = "array(named_struct('kind', {}, 'lead', {}, 'shown', {}))"
    # a word without a known gender has that of its first place in the text that shows one
    kind = f"coalesce(get(filter({names}, n -> n.word = {{}} AND n.kind <> 'given'), 0).kind, 'given')"
    name = (f"transform({_name_words('e')}, p -> named_struct('kind', if(p.kind = 'given', {kind.format('p.shown')}, p.kind), "
            "'lead', p.lead, 'shown', p.shown))")
    lead_of_secret = rf"regexp_extract(e, {_q('^' + SECRET_WORDS)}, 0)"
    return f"""CASE
      WHEN length({lead_of_secret}) > 0 THEN {one.format("'key'", lead_of_secret, f'substr(e, 1 + length({lead_of_secret}))')}
      WHEN e LIKE '%@%' THEN {one.format("'mail'", "''", 'e')}
      WHEN e LIKE 'AKIA%' AND length(e) = 20 THEN {one.format("'key'", "'AKIA'", 'substr(e, 5)')}
      WHEN e rlike r'^{TITLE}' THEN {name}
      WHEN e rlike r'^\\p{{Lu}}\\p{{L}}+$' THEN {one.format(kind.format('e'), "''", 'e')}
      WHEN e rlike r'^[A-Z]' THEN {one.format("'account'", 'substr(e, 1, 2)', 'substr(e, 3)')}
      WHEN e rlike r'^(?:{OCTET}\\.){{3}}{OCTET}$' THEN {one.format("'address'", "''", 'e')}
      WHEN e LIKE '+%' THEN {one.format("'phone'", 'substr(e, 1, 2)', 'substr(e, 3)')}
      WHEN length({digits}) >= 13 THEN {one.format("'card'", "''", 'e')}
      ELSE {one.format("'number'", "''", 'e')} END"""


def _normal(kind: Column, shown: Column) -> Column:
    """What counts as the same unit: numbers by their digits, accounts without blanks, mail and names without case."""
    return (F.when(kind.isin("phone", "card", "number"), F.regexp_replace(shown, r"\D", ""))
            .when(kind == "account", F.regexp_replace(shown, " ", ""))
            .when(kind.isin("mail", *NAME_KINDS), F.lower(shown)).otherwise(shown))


def _noise(i: str) -> str:
    """SQL: a number below 65536 for position ``i`` out of the hash ``h``."""
    return f"int(conv(substr(h, 1 + ({i} * 4) % 124, 4), 16, 10)) + int({i} / 31)"


def _scrambled(text: str) -> str:
    """SQL: other digits and letters in the place of those of ``text``, within the script."""
    v = _noise("i")
    letters = " ".join(
        f"WHEN c BETWEEN '{a}' AND '{z}' THEN substr('{alphabet}', 1 + ({v}) % {len(alphabet)}, 1)"
        for a, z, alphabet in (("A", "Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("а", "я", "абвгдежзиклмнопрст"), ("А", "Я", "АБВГДЕЖЗИКЛМНОПРСТ"),
                               ("α", "ω", "αβγδεζηθικλμνξοπρστυφχψω")))
    return f"""array_join(transform(filter(split({text}, ''), c -> c <> ''), (c, i) -> CASE
        WHEN c BETWEEN '0' AND '9' THEN string(({v}) % 10) {letters}
        WHEN {text} rlike '^[0-9a-f]+$' THEN substr('abcdef', 1 + ({v}) % 6, 1)
        WHEN c rlike r'\\p{{L}}' THEN substr('abcdefghijklmnopqrstuvwxyz', 1 + ({v}) % 26, 1) ELSE c END), '')"""


def _more() -> str:
    """SQL: by how much the surrogate is longer than the unit's format asks for."""
    return f"greatest(attempt - {PATIENCE}, 0)"


def _digits() -> str:
    """SQL: the digits that a longer surrogate has more."""
    return f"substr(translate(h, 'abcdef', '012345'), 64, {_more()})"


def _letters() -> str:
    """SQL: the letters that a longer surrogate has more."""
    return f"substr(translate(h, '0123456789', 'ghijklmnop'), 64, {_more()})"


def _syllables() -> str:
    """SQL: a name of some syllables; its end shows the gender."""
    cases = []
    for script, consonants, vowels in SCRIPTS:
        pair = (f"concat(substr('{consonants}', 1 + ({_noise('2 * i')}) % {len(consonants)}, 1), "
                f"substr('{vowels}', 1 + ({_noise('2 * i + 1')}) % {len(vowels)}, 1))")
        base = f"array_join(transform(sequence(0, {SYLLABLES - 1} + {_more()}), i -> {pair}), '')"
        end = f"CASE kind WHEN 'female' THEN '{consonants[6]}{vowels[0]}' WHEN 'male' THEN '{vowels[3]}{consonants[6]}' ELSE '{consonants[3]}' END"
        named = f"concat({base}, {end})"
        cases.append(f"WHEN unit rlike r'\\p{{Is{script}}}' THEN {named}" if script != "Latin" else f"ELSE {named}")
    return "CASE " + " ".join(cases) + " END"


def _surrogate() -> str:
    """SQL: surrogate of ``kind`` and ``unit`` from the hash ``h``."""
    body = f"substr({_scrambled('unit')}, 2)"
    card = f"concat(substr(unit, 1, 1), substr({body}, 1, length(unit) - 2), {_digits()})"
    local, domain = "substring_index(unit, '@', 1)", "substring_index(unit, '@', -1)"
    octets = f"array_join(transform(sequence(0, 3), i -> string(1 + ({_noise('i')}) % 254)), '.')"
    return f"""CASE
      WHEN kind = 'mail' THEN concat({_scrambled(local)}, {_letters()}, '@',
          substr({_scrambled(domain)}, 1, length({domain}) - length(substring_index({domain}, '.', -1)) - 1), '.', substring_index({domain}, '.', -1))
      WHEN kind = 'address' THEN concat({octets}, {_digits()})
      WHEN kind = 'card' THEN concat({card}, string((10 - {_luhn(f"concat({card}, '0')")}) % 10))
      WHEN kind IN {NAME_KINDS} THEN {_syllables()}
      WHEN kind = 'key' AND length(regexp_replace(unit, r'[^\\p{{L}}0-9]', '')) < 8 THEN concat({_scrambled('unit')}, substr(h, 121, 8), {_letters()})
      WHEN kind = 'key' THEN concat({_scrambled('unit')}, {_letters()})
      ELSE concat({_scrambled('unit')}, {_digits()}) END"""


def _hashed(units: DataFrame, key: str) -> DataFrame:
    text = F.concat_ws("\x1f", F.lit(key), "kind", "unit", F.col("attempt").cast("string"))
    return units.withColumn("h", F.sha2(text, 512)).withColumn("surrogate", F.expr(_surrogate())).drop("h")


def surrogates(units: DataFrame, key: str) -> DataFrame:
    """``kind``, ``unit``, ``surrogate`` of distinct units, without clashes.

    Each round hashes the units that clash anew; from round ``PATIENCE`` on their surrogates grow. An IPv4 address
    that finds none free gets digits behind its last part, then no valid address any more; a card number keeps its check digit.
    """
    named = materialise(_hashed(units.distinct().withColumn("attempt", F.lit(0)), key), "units")
    while True:
        owner = named.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "unit")).alias("owner"), F.count(F.lit(1)).alias("n"))
        shared = owner.where("n > 1").select("kind", "surrogate", F.col("owner.unit").alias("keeps"))
        real = named.select("kind", F.col("unit").alias("surrogate")).withColumn("keeps", F.lit(None).cast("string"))
        taken = named.select("kind", "surrogate").distinct().join(real, ["kind", "surrogate"])
        # a surrogate that occurs as a unit goes to nobody
        clashes = materialise(shared.unionByName(taken).groupBy("kind", "surrogate").agg(
            F.count("keeps").alias("named"), F.count(F.lit(1)).alias("rules"), F.max("keeps").alias("keeps")), "clashes")
        if clashes.isEmpty():
            return named.select("kind", "unit", "surrogate")
        again = named.join(clashes, ["kind", "surrogate"], "left")
        moves = F.col("rules").isNotNull() & ((F.col("named") < F.col("rules")) | (F.col("unit") != F.col("keeps")))
        named = materialise(_hashed(again.select("kind", "unit", (F.col("attempt") + moves.cast("int")).alias("attempt")), key), "units")


def _shown_again() -> str:
    """SQL: surrogate in the form of the text that it replaces."""
    at = r"length(regexp_replace(substr(shown, 1, i + 1), r'\D', ''))"
    filled = f"array_join(transform(filter(split(shown, ''), c -> c <> ''), (c, i) -> if(c BETWEEN '0' AND '9', substr(surrogate, {at}, 1), c)), '')"
    spaced = ("array_join(transform(filter(split(shown, ''), c -> c <> ''), (c, i) -> "
              "if(c = ' ', c, substr(surrogate, length(replace(substr(shown, 1, i + 1), ' ', '')), 1))), '')")
    # a longer surrogate's further digits follow
    rest = r"substr(surrogate, 1 + length(regexp_replace(shown, {}, '')))"
    return f"""CASE WHEN kind IN ('phone', 'card', 'number') THEN concat({filled}, {rest.format(_q(chr(92) + 'D'))})
      WHEN kind = 'account' THEN concat({spaced}, {rest.format("' '")})
      WHEN kind IN {NAME_KINDS} THEN if(shown = upper(shown) AND length(shown) > 1, upper(surrogate), initcap(surrogate))
      ELSE surrogate END"""


def replace_entities(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the texts; with ``count_col``, a column with the number of entities more.

    All columns are kept. Null and empty texts stay as they are. Repeated rows get
    equal texts. A text without entities is passed on and takes no part in a shuffle.
    A name behind a title is replaced wherever its words stand in that text. A short
    secret gets a longer surrogate, as few would be free in its own length.
    A digit string of card length that is no valid card number stays, but for the
    shorter entities in it.
    """
    clash = "_pii_"  # own names, so that no column of docs can clash
    text = docs[text_col]
    has = F.coalesce(text.rlike(f"{HEAD}|{CARD_START}|{TAIL}"), F.lit(False))
    plain = docs.where(~has)
    found = _with_cards(docs.where(has), text, clash + "cards").withColumn(clash + "key", F.sha2(text, 256))
    titled = found.withColumn(clash + "found", F.regexp_extract_all(text, F.lit(NAME), F.lit(0)))
    names = f"transform(flatten(transform({clash}found, e -> {_name_words('e')})), p -> struct(p.shown AS word, p.kind AS kind))"
    found = titled.withColumn(clash + "names", F.array_distinct(F.expr(names)))
    pattern = _pattern(F.col(clash + "cards"), F.col(clash + "names"))
    found = found.withColumn(clash + "found", F.regexp_extract_all(text, pattern, F.lit(0)))
    parts = F.expr(f"flatten(transform({clash}found, (e, j) -> transform({_parts(clash + 'names')}, (p, k) -> "
                   "struct(p.kind AS kind, p.lead AS lead, p.shown AS shown, j AS j, k AS k))))")
    found = materialise(found.withColumn(clash + "parts", parts).drop(clash + "found"), "entities")
    none = F.size(clash + "parts") == 0
    plain = plain.unionByName(found.where(none).select(*docs.columns)).withColumn(clash + "n", F.lit(0).cast("bigint"))
    found = found.where(~none)
    # equal texts have equal parts
    texts = found.groupBy(clash + "key").agg(F.first(clash + "parts").alias("parts"))
    rows = texts.select(F.col(clash + "key").alias("at"), F.posexplode("parts").alias("pos", "part"))
    rows = rows.select("at", "pos", F.col("part.kind").alias("kind"), F.col("part.shown").alias("shown"),
                       _normal(F.col("part.kind"), F.col("part.shown")).alias("unit"))
    rows = materialise(rows, "occurrences")
    chosen = surrogates(rows.select("kind", "unit"), key)
    shown = rows.join(chosen, ["kind", "unit"]).withColumn("shown", F.expr(_shown_again()))
    lists = shown.groupBy("at").agg(F.expr("transform(array_sort(collect_list(struct(pos, shown))), x -> x.shown)").alias(clash + "shown"))
    lists = lists.withColumnRenamed("at", clash + "at")
    joined = found.join(lists, found[clash + "key"] == lists[clash + "at"])
    gaps = F.split(F.col(text_col), pattern, -1)
    joined = joined.withColumn(clash + "gaps", gaps)
    new = F.expr(f"concat(array_join(zip_with({clash}parts, {clash}shown, (p, s) -> concat(if(p.k = 0, {clash}gaps[p.j], ''), p.lead, s)), ''), "
                 f"element_at({clash}gaps, -1))")
    counted = F.expr(f"bigint(size(filter({clash}parts, p -> p.k = 0)))")
    done = joined.withColumns({text_col: new, clash + "n": counted}).select(*docs.columns, clash + "n")
    out = plain.unionByName(done)
    return out.withColumnRenamed(clash + "n", count_col) if count_col else out.drop(clash + "n")
