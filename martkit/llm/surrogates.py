"""Surrogates for personal data, in column expressions alone.

Mails, addresses of machines, phone numbers, cards, accounts, secrets and persons are found by
one pattern and replaced by others of the same kind: same length, punctuation, letter case and
script (letters of scripts without a list here become Latin ones), same gender of given names, same validity of check digits.  The replacement is a function of a
secret key and the entity alone, so a person or number is the same everywhere in the corpus
(whatever its letter case or separators).  Entities of the corpus are then checked against each
other: where two would share a replacement, or one would equal an entity that occurs, one of
them moves to the next attempt, until all are distinct.  After every ATTEMPTS attempts its form grows by a letter or digit at
the end, so there is always room, however many entities of one short form a corpus holds.

Texts are cut at the matches and joined again, so nothing outside a match changes.  The check
runs over distinct entities; only those that had to move are joined back to their documents.

Null texts stay null and empty ones empty; both count no entities.  Repeated rows get equal
results.  Other columns are not read by ``surrogate_report`` and kept by ``replace_entities``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window, functions as F

from martkit.llm.base import let, stored

KEY = "change-me"
#: Attempts at one length.
ATTEMPTS = 20

# Given names by script and gender.
GIVEN = {
    ("latin", "f"): ("Maria Anna Laura Julia Sarah Emma Sofia Elena Claire Camille Julie Katharina Ingrid Carmen "
                     "Lucia Isabel Alice Charlotte Hannah Olivia Emily Margaret Susan Linda").split(),
    ("latin", "m"): ("John James Robert Michael William David Thomas Daniel Peter Paul Hans Klaus Jürgen Stefan "
                     "Pierre Jacques Antoine Luis Carlos Miguel Javier Diego Henry George").split(),
    ("cyrillic", "f"): "Мария Анна Елена Ольга Наталья Татьяна Ирина Светлана".split(),
    ("cyrillic", "m"): "Иван Сергей Алексей Дмитрий Андрей Михаил Николай Владимир".split(),
}
# Forms of address, which keep their place and so their gender.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Señor Señora Monsieur Madame".split()

_NAMES = "|".join(n for names in GIVEN.values() for n in names)
_SURNAME = r"\p{Lu}\p{Ll}+(?:[-']\p{Lu}\p{Ll}+)*"
# Scripts without spaces between words.  A mail address is of these or of other letters, so the
# sentence around an address does not belong to it.
_JOINED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_HOST = (rf"(?:[\p{{L}}\p{{M}}\p{{N}}\-&&[^{_JOINED}]]+|[{_JOINED}]+)"
         rf"(?:\.(?:[\p{{L}}\p{{M}}\p{{N}}\-&&[^{_JOINED}]]+|[{_JOINED}]+))*"
         rf"\.(?:[\p{{L}}\p{{M}}&&[^{_JOINED}]]{{2,}}|[{_JOINED}]{{2,}})")
_LOCAL = rf"[\p{{L}}\p{{M}}\p{{N}}_.+\-&&[^{_JOINED}]]"
PATTERNS = {
    # The first test of each branch is only there to fail fast, as is the ASCII run; "@" is in no class, so nothing need be
    # given back.
    "mail": (rf"(?:(?<![A-Za-z0-9])(?<!{_LOCAL})[\p{{L}}\p{{N}}&&[^{_JOINED}]](?:[A-Za-z0-9_.+\-]++|{_LOCAL})*+"
             rf"|(?=[^\x00-\x7F])(?<![{_JOINED}])[{_JOINED}]++)@{_HOST}"),
    "ip": r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![\w]|\.[0-9])",
    "account": r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w])",
    "social": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": (r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)"
              r"|(?<![\w+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\w)"),
    "secret": (r"(?<!\w)(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,}(?!\w)"
               r"|(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|sk-[0-9A-Za-z-]{20,})(?!\w)"),
    "person": rf"(?<![\p{{L}}\p{{M}}])(?:(?:{'|'.join(TITLES)})\.? {_SURNAME}(?: {_SURNAME})?|(?:{_NAMES}) {_SURNAME})(?![\p{{L}}\p{{M}}])",
}
# What a match of any kind but mail begins with, tried before their branches.
_START = r"(?=[\p{Lu}0-9+(]|[a-f][0-9A-Fa-f]{31}|gh[pousr]_|sk-)"
NO_MAIL = f"{_START}(?:{'|'.join(p for kind, p in PATTERNS.items() if kind != 'mail')})"
ANY = f"{PATTERNS['mail']}|{NO_MAIL}"
# Set around matches; texts that hold it themselves are cut by the pattern instead.
_MARK = "\x01"


def _by_pattern(text: Column, use) -> Column:
    """``use`` of the pattern that a text needs: without an "@" there is no mail address to look for."""
    return F.when(text.contains("@"), use(F.lit(ANY))).otherwise(use(F.lit(NO_MAIL)))


def mentions_of(text: Column) -> Column:
    """All matches of a text, in order."""
    return _by_pattern(text, lambda pattern: F.regexp_extract_all(text, pattern, F.lit(0)))


def _cut(text: Column) -> Column:
    """(pieces, found): the matches of a text and what stands around them, one piece more than matches, by one scan."""
    marked = _by_pattern(text, lambda pattern: F.regexp_replace(text, pattern, F.lit(f"{_MARK}$0{_MARK}")))
    at_marks = let(F.split(marked, _MARK, -1), lambda parts: F.struct(
        F.filter(parts, lambda _, i: i % 2 == 0).alias("pieces"), F.filter(parts, lambda _, i: i % 2 == 1).alias("found")))
    by_pattern = F.struct(F.split(text, ANY, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found"))
    return F.when(text.contains(_MARK), by_pattern).otherwise(at_marks)


def _next_names(key: str) -> dict[str, str]:
    """Each given name's replacement: the next of its list in keyed order, so one to one and never itself."""
    out = {}
    for names in GIVEN.values():
        order = sorted(names, key=lambda n: hashlib.sha256(f"{key}\1{n}".encode()).digest())
        out.update(zip(order, order[1:] + order[:1]))
    return out


def kind_of(m: Column) -> Column:
    """The kind of a match.  Kinds are told apart by form, in the order of the pattern."""
    out = F.lit("person")
    for name in ("secret", "phone", "social", "card", "account", "ip"):
        out = F.when(F.regexp_like(m, F.lit(f"^(?:{PATTERNS[name]})$")), F.lit(name)).otherwise(out)
    return F.when(m.contains("@"), F.lit("mail")).otherwise(out)


def _first_words(m: Column) -> Column:
    """Of a person's name: title and given name, as they stand."""
    return F.regexp_extract(m, rf"^(?:(?:{'|'.join(TITLES)})\.? )?(?:(?:{_NAMES}) )?", 0)


def canonical(m: Column, kind: Column) -> Column:
    """What makes two mentions the same entity."""
    alone = F.regexp_replace(m, r"[^0-9A-Za-z]", "")
    return (F.when(kind.isin("phone", "card", "social"), alone).when(kind == "account", F.lower(alone))
            .when(kind.isin("mail", "secret"), F.lower(m))
            .when(kind == "person", F.lower(F.substring(m, F.length(_first_words(m)) + 1, F.length(m)))).otherwise(m))


# Letters by script and sort; a letter is replaced by one of its own list.
_LETTERS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåèéêëìíîïòóôõöùúûü", "çñßýÿšžčćđ", "аеиоуыэюя",
            "бвгджзйклмнпрстфхцчшщъь", "αεηιουω", "βγδζθκλμνξπρστφχψ"]


def _letter(digest: Column, i: Column, alphabet: Column) -> Column:
    return F.substring(alphabet, (F.pmod(F.xxhash64(digest, i), F.length(alphabet)) + 1).cast("int"), F.lit(1))


def _like(c: Column, digest: Column, i: Column, hex_only: Column) -> Column:
    """A character of the same sort as ``c``, chosen by the digest."""
    low = F.lower(c)
    alphabet = F.when(F.regexp_like(c, F.lit("[0-9]")), F.lit("0123456789")).when(
        hex_only & F.regexp_like(low, F.lit("[a-f]")), F.lit("abcdef"))
    for letters in _LETTERS:
        alphabet = alphabet.when(F.instr(F.lit(letters), low) > 0, F.lit(letters))
    # Letters and digits that no list holds must not stay either.
    alphabet = alphabet.when(F.regexp_like(c, F.lit(r"\p{L}")), F.lit(_LETTERS[1])).when(
        F.regexp_like(c, F.lit(r"\p{N}")), F.lit("0123456789"))
    return F.when(alphabet.isNull() | (F.length(c) == 0), c).otherwise(_letter(digest, i, alphabet))


def _fill(surface: Column, digest: Column, hex_only: Column) -> Column:
    """``surface`` with letters and digits replaced in order; case and everything else stay."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(a: Column, c: Column) -> Column:
        new = _like(c, digest, a["n"], hex_only)
        new = F.when(F.upper(c) == F.lower(c), new).when(c == F.upper(c), F.upper(new)).otherwise(new)
        return F.struct(F.concat(a["out"], new).alias("out"),
                        (a["n"] + F.regexp_like(c, F.lit(r"[\p{L}\p{N}]")).cast("int")).alias("n"))
    return F.aggregate(F.split(surface, ""), start, step, lambda a: a["out"])


def _digits(surface: Column, core: Column) -> Column:
    """``surface`` with its digits replaced by those of ``core`` in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("n"))

    def step(a: Column, c: Column) -> Column:
        digit = F.regexp_like(c, F.lit("^[0-9]$"))
        return F.struct(F.concat(a["out"], F.when(digit, F.substring(core, a["n"], F.lit(1))).otherwise(c)).alias("out"),
                        (a["n"] + digit.cast("int")).alias("n"))
    return F.aggregate(F.split(surface, ""), start, step, lambda a: a["out"])


def _luhn(digits: Column) -> Column:
    """The check sum of a card number; a multiple of ten if the number is valid."""
    def weigh(a: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return a + F.when(i % 2 == 0, doubled).otherwise(d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), weigh)


def _core(m: Column, digits: Column, kind: Column, digest: Column) -> Column:
    """The digits of a number's replacement: what tells the issuer or the country stays."""
    prefix = F.when(kind == "card", F.lit(1)).when(
        kind == "phone", F.length(F.regexp_extract(m, r"^\+([0-9]{1,3})(?=[ .(-])", 1))).otherwise(F.lit(0))
    made = let(F.concat(F.substring(digits, F.lit(1), prefix), F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(digits)), lambda i: _letter(digest, i, F.lit("0123456789"))), "")),
        lambda s: F.substring(s, F.lit(1), F.length(digits)))
    body = F.substring(made, F.lit(1), F.length(digits) - 1)
    valid = let(body, lambda b: F.concat(b, F.pmod(-_luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    return F.when((kind == "card") & (_luhn(digits) % 10 == 0), valid).otherwise(made)


def _more(digest: Column, grown: Column, alphabet: str) -> Column:
    """So many further letters or digits."""
    return F.when(grown == 0, F.lit("")).otherwise(F.array_join(F.transform(
        F.sequence(F.lit(1), F.greatest(grown, F.lit(1))), lambda i: _letter(digest, i + 1000, F.lit(alphabet))), ""))


def surrogate(m: Column, kind: Column, canon: Column, attempt: Column, key: str = KEY) -> Column:
    """The replacement of a mention, a function of the key, the entity and the attempt."""
    def body(p: Column) -> Column:
        m, kind, digest, grown = p["m"], p["kind"], p["digest"], p["grown"]
        letters, numbers = _more(digest, grown, _LETTERS[1]), _more(digest, grown, "0123456789")
        part = [F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(n)) for i, n in enumerate((14, 256, 256, 254))]
        # 240.0.0.0 and above are never assigned to a machine.
        ip = F.concat(F.concat_ws(".", part[0] + 240, part[1], part[2], part[3] + 1), F.when(grown == 0, "").otherwise("."), numbers)
        host = F.substring(m, F.instr(m, "@") + 1, F.length(m))
        top = F.concat(F.lit("."), F.substring_index(host, ".", -1))
        name = F.substring(host, F.lit(1), F.length(host) - F.length(top))
        place = F.sha2(F.concat_ws("\1", F.lit(key), F.lit("host"), F.lower(host)), 256)
        mail = F.concat(_fill(F.substring_index(m, "@", 1), digest, F.lit(False)), letters, F.lit("@"),
                        _fill(name, place, F.lit(False)), top)
        given = F.create_map(*[F.lit(x) for pair in _next_names(key).items() for x in pair])
        first = p["first"]
        spoken = F.regexp_extract(first, rf"(?:{_NAMES})(?= $)", 0)
        title = F.substring(first, F.lit(1), F.length(first) - F.length(spoken) - 1)
        person = F.concat(
            F.when(spoken == "", first).otherwise(F.concat(title, F.element_at(given, spoken), F.lit(" "))),
            _fill(F.substring(m, F.length(first) + 1, F.length(m)), digest, F.lit(False)), letters)
        number = let(_core(m, F.regexp_replace(m, "[^0-9]", ""), kind, digest), lambda core: _digits(m, core))
        return (F.when(kind == "mail", mail).when(kind == "ip", ip).when(kind == "person", person)
                .when(kind.isin("phone", "card", "social"), F.concat(number, numbers))
                .otherwise(F.concat(_fill(m, digest, F.regexp_like(m, F.lit("^[0-9A-Fa-f]+$"))), numbers)))
    digest = F.sha2(F.concat_ws("\1", F.lit(key), kind, canon, attempt.cast("string")), 256)
    return let(F.struct(m.alias("m"), kind.alias("kind"), digest.alias("digest"), _first_words(m).alias("first"),
                        F.floor(attempt / ATTEMPTS).cast("int").alias("grown")), body)


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct entities of the corpus: kind, canon and one mention of each."""
    return _distinct_entities(docs.select(F.explode(mentions_of(F.col(f"`{text}`").cast("string"))).alias("m")))


def _distinct_entities(mentions: DataFrame) -> DataFrame:
    kinds = mentions.select("m").distinct().select("m", kind_of(F.col("m")).alias("kind"))
    return kinds.groupBy("kind", canonical(F.col("m"), F.col("kind")).alias("canon")).agg(F.min("m").alias("m"))


def moved_entities(found: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canon, attempt) of the entities whose first replacement was not theirs alone."""
    # Persons are told apart by their surname alone: its replacement is what must be distinct.
    pending = found.select("kind", "canon", "m", F.lit(0).alias("attempt"))
    taken = None
    names = found.select("kind", F.col("canon").alias("made"))
    order = Window.partitionBy("kind", "made").orderBy("canon")
    while True:  # ends, as forms grow while any are left
        made = surrogate(F.col("m"), F.col("kind"), F.col("canon"), F.col("attempt"), key)
        tried = pending.withColumn("made", made).withColumn("made", canonical(F.col("made"), F.col("kind")))
        tried = stored(tried.withColumn("place", F.row_number().over(order)), "surrogates-tried")
        good = tried.filter("place = 1").join(names, ["kind", "made"], "left_anti")
        if taken is not None:
            good = good.join(taken.select("kind", "made"), ["kind", "made"], "left_anti")
        good = stored(good.select("kind", "canon", "attempt", "made"), "surrogates-taken")
        taken = good if taken is None else taken.unionByName(good)
        pending = stored(tried.join(good, ["kind", "canon"], "left_anti").select(
            "kind", "canon", "m", (F.col("attempt") + 1).alias("attempt")), "surrogates-pending")
        if pending.isEmpty():
            break
    return taken.filter("attempt > 0").select("kind", "canon", "attempt")


def _replaced(text: Column, attempts: Column | None, key: str) -> Column:
    """(text, kinds): the text with every match replaced, and the kinds of the matches."""
    def one(m: Column) -> Column:
        def body(p: Column) -> Column:
            tries = F.lit(0) if attempts is None else F.coalesce(
                F.element_at(attempts, F.concat_ws("\1", p["kind"], p["canon"])), F.lit(0))
            return F.struct(surrogate(p["m"], p["kind"], p["canon"], tries, key).alias("made"), p["kind"].alias("kind"))
        return let(F.struct(m.alias("m"), kind_of(m).alias("kind")), lambda p: let(
            F.struct(p["m"].alias("m"), p["kind"].alias("kind"), canonical(p["m"], p["kind"]).alias("canon")), body))

    none = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    # The last piece is joined to nothing.
    done = let(_cut(text), lambda cut: let(
        F.struct(cut["pieces"].alias("pieces"), F.transform(cut["found"], one).alias("made")), lambda cut: F.struct(
            F.array_join(F.zip_with(cut["pieces"], cut["made"], lambda piece, s: F.concat(
                piece, F.coalesce(s["made"], F.lit("")))), "").alias("text"),
            F.transform(cut["made"], lambda s: s["kind"]).alias("kinds"))))
    return F.when(text.isNull(), none).otherwise(done)


def with_surrogates(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``row`` (all columns as they came) and ``new`` (text, kinds)."""
    value = F.col(f"`{text}`").cast("string")
    # The matches of every text with its checksum, written once: whose they are, and which documents hold them.
    mentions = stored(docs.select(F.md5(value.cast("binary")).alias("sum"), F.explode(
        F.array_distinct(mentions_of(value))).alias("m")), "surrogates-mentions")
    moved = stored(moved_entities(stored(_distinct_entities(mentions), "surrogates-entities"), key), "surrogates-moved")
    rows = docs.select(F.struct("*").alias("row"), value.alias("text"))
    if moved.isEmpty():
        return rows.select("row", _replaced(F.col("text"), None, key).alias("new"))
    # Documents that hold a moved entity, by the checksum of their text: equal texts need equal maps.
    mentions = mentions.distinct().withColumn("kind", kind_of(F.col("m"))).withColumn("canon", canonical(F.col("m"), F.col("kind")))
    maps = mentions.select("sum", "kind", "canon").distinct().join(moved, ["kind", "canon"]).groupBy("sum").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\1", "kind", "canon"), "attempt"))).alias("attempts"))
    joined = rows.withColumn("sum", F.md5(F.col("text").cast("binary"))).join(stored(maps, "surrogates-maps"), "sum", "left")
    return joined.select("row", _replaced(F.col("text"), F.col("attempts"), key).alias("new"))


def replace_entities(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with the entities of ``text`` replaced; all columns kept in place."""
    made = with_surrogates(docs, key, text)
    return made.select([F.col("new.text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def surrogate_report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Per document: the new text, how many mentions were replaced and of which kinds."""
    made = with_surrogates(docs.select("doc_id", "text"), key)
    return made.select("row.doc_id", "new.text", F.coalesce(F.size("new.kinds"), F.lit(0)).alias("n_entities"),
                       F.array_join(F.array_sort(F.array_distinct("new.kinds")), ",").alias("kinds"))
