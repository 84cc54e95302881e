"""Secret scans: candidates by pattern, false positives removed by a random forest.

Everything is DataFrame and SQL functions.  Every value behind a key word with =
or :, whatever its length and signs (a quoted one whole, with its spaces), every
key of a known form (JWTs whole, with their dots) and every long run of key-like
characters with a digit is a candidate, however many a word holds: an
assignment, URL or pair of credentials gives each of its parts, judged by the
text before it.  Its features are length, character classes, how likely its transitions from
character to character are in words, how much of it dictionary words cover, words of its path, and
the words beside it.  The dictionary is the most frequent DICTIONARY_WORDS words of a public
vocabulary (those of LEAST_WORD letters or more), and transitions are counted in them, in lower
case, upper case and with a capital.  A
random forest (MLlib) trained from labelled findings turns them into a
probability; its trees become one SQL expression, so texts are scored in
place, row by row, without a shuffle.  Private-key blocks are findings as they
stand.

Labelled findings: `findings` takes any table of text, path and label with a
candidate a text, or with a column secret that says which of a text's
candidates the label is of (the others are none); without one it learns from `example_findings`, which are made
by rule from numbers, the same every time.

Nulls, empty and long texts: null and empty texts have no findings; long texts
are read whole.  A null path has no path words; a null id stays null.  A secret
that comes several times in a text is one finding with its first place and its
number of occurrences, those inside longer secrets not counted; longer secrets are redacted first; one that
could be a word of prose counts only behind its key word, and is redacted only there; of equal secrets the
best score counts; repeated rows are scanned each; an empty table gives no rows.  Other columns are never
looked at.
"""

from __future__ import annotations

import functools
import json
import math
from collections import Counter

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.batches import table
from sluice.llm.scratch import settled

DICTIONARY_WORDS, LEAST_WORD = 4000, 4
LEAST, THRESHOLD, TREES, DEPTH, EXAMPLES = 12, 0.5, 24, 6, 8000
#: A text without this has no candidate, and its words are not looked at.
JWT = r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)*"
#: Signs of equality are padding only where no value follows.
PADDING = r"""(?:==?(?!=|["'`]?[A-Za-z0-9+/_-]))?"""
SERVICE = r"(?<![A-Za-z0-9])(?:gh[pousr]_|xox[abprs]-|sk_live_|sk-|AIza|glpat-|eyJ)[A-Za-z0-9+/_-]+"
CORE = rf"{JWT}|{SERVICE}{PADDING}|(?:AKIA|ASIA)[0-9A-Z]{{16}}|(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{{LEAST},}}{PADDING}"
CUT = r"""[\s"'`<>(){}\[\]|,;]+"""
BLOCK = r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?(?:-----END [A-Z ]*PRIVATE KEY-----|$)"
#: Words by which keys and placeholders are told.
KEY_WORDS = (
    "token",
    "secret",
    "password",
    "passwd",
    "pwd",
    "passphrase",
    "apikey",
    "api_key",
    "api-key",
    "access_key",
    "access-key",
    "private_key",
    "credential",
    "bearer",
    "authorization",
    "auth",
)
PUBLIC_WORDS = (
    "commit",
    "sha1",
    "sha256",
    "md5",
    "checksum",
    "digest",
    "etag",
    "hash",
    "uuid",
    "guid",
    "revision",
    "order",
    "invoice",
    "version",
    "card",
    "phone",
    "serial",
)
PLACE_WORDS = ("example", "sample", "dummy", "changeme", "placeholder", "your", "here", "xxxx", "test", "todo", "insert", "replace")
PREFIX = r"^(AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk_live_|sk-|AIza|glpat-|eyJ)"

#: Stand around every candidate of a text while it is cut, and behind a key word; texts' own become line ends.
EDGE, LEAD, NEAR = "\x01", "\x02", 200
#: A name with a key word in it and = or : behind it, and the value: quoted, or up to space, closing signs or the next name.
NAME = rf"""(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{{1,99}}["'\]]{{0,2}}\s{{0,4}}[=:])[A-Za-z0-9_-]*?(?i:{"|".join(KEY_WORDS[:-1])}|auth(?!or))[A-Za-z0-9_-]*["'\]]{{0,2}}\s{{0,4}}(?::=|=>|==|[=:])\s{{0,4}}(?:(?i:bearer|basic|token)\s{{1,4}})?"""
END = r"""(?![.,;:)\]}|&]{1,8}(?:[\s"'`<>]|\z))(?![&,;|][A-Za-z0-9_.-]{1,99}[=:])"""
VALUE = rf"""(?:{END}[^\s"'`<>\x01\x02])++"""
KEYED = rf"""({NAME}")([^"\n]+)(?=")|({NAME}')([^'\n]+)(?=')|({NAME}["'`]?)({VALUE})"""
CANDIDATE = rf"{KEYED}|({CORE})"


#: Symbols that transitions are told by: no letter or digit, letters, any digit.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = len(LETTERS) + 2


def dictionary(path: str | None = None, most: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent whole words of a vocabulary file (their numbers are in order of frequency)."""
    with open(path or public_tokenizers.path("word_bpe_49k.json")) as f:
        model = json.load(f)["model"]
    end = model["end_of_word_suffix"]
    words = ((i, w.removesuffix(end)) for w, i in model["vocab"].items() if w.endswith(end))
    return [w for _, w in sorted((i, w) for i, w in words if w.isascii() and w.isalpha() and len(w) >= LEAST_WORD)[:most]]


def pattern(words: list[str]) -> str:
    """A pattern of the longest word at a place, as a tree: what words begin with is tried once."""
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def written(node: dict) -> str:
        ways = [c + written(rest) for c, rest in sorted(node.items()) if c]
        if not ways:
            return ""
        return f"(?:{'|'.join(ways)})" + ("?" if "" in node else "")

    return written(tree)


def transitions(words: list[str], least: float = 0.1) -> list[float]:
    """Log-probability of each symbol behind each other, by how often it comes in words."""
    symbol = lambda c: LETTERS.index(c) + 1
    counts: Counter = Counter()
    for word in words:
        for w in (word, word.upper(), word.capitalize()):
            counts.update(zip(map(symbol, w), map(symbol, w[1:])))
    rows = [[counts[a, b] + least for b in range(SYMBOLS)] for a in range(SYMBOLS)]
    return [round(math.log(x / sum(row)), 4) for row in rows for x in row]


@functools.cache
def lexicon(path: str | None = None) -> tuple[str, str]:
    """(the dictionary's pattern, the transitions as a SQL array)."""
    words = dictionary(path)
    return pattern(words), f"array({', '.join(f'{x}D' for x in transitions(words))})"


def _any(words: tuple[str, ...]) -> str:
    return "|".join(words)


#: Name and SQL of each feature of a candidate c: lead (the key word and sign it stands behind, or ''), core, word (up to the core's end), before, before2, tail (the word from there), after, path.
FEATURES = {
    "length": "length(c.core)",
    "digits": "regexp_count(c.core, '[0-9]') / length(c.core)",
    "uppers": "regexp_count(c.core, '[A-Z]') / length(c.core)",
    "signs": "regexp_count(c.core, '[+/_=-]') / length(c.core)",
    "transitions": "aggregate(c.steps, 0D, (n, x) -> n + x) / greatest(1, size(c.steps))",
    "rarest": "coalesce(array_min(c.steps), 0D)",
    "distinct": "size(array_distinct(split(c.core, ''))) / length(c.core)",
    "hex": "cast(c.core rlike '^[0-9a-fA-F]+$' as int)",
    "numeric": "cast(c.core rlike '^[0-9-]+$' as int)",
    "prefix": f"cast(c.core rlike '{PREFIX}' as int)",
    "covered": "1 - length(regexp_replace(lower(c.core), '{words}', '')) / length(c.core)",
    "place": f"cast(lower(c.core) rlike '{_any(PLACE_WORDS)}' as int)",
    "own_key": f"cast(lower(c.word) rlike '({_any(KEY_WORDS)})[^a-z0-9]*[=:]' as int)",
    "key_before": f"cast(lower(concat_ws(' ', c.before2, c.before)) rlike '{_any(KEY_WORDS)}' as int)",
    "public_before": f"cast(lower(concat_ws(' ', c.before2, c.before, c.word)) rlike '{_any(PUBLIC_WORDS)}' as int)",
    "given": "cast(concat_ws(' ', c.before, c.word) rlike '[=:]' as int)",
    "place_near": f"cast(lower(concat_ws(' ', c.before2, c.before, c.after)) rlike '{_any(PLACE_WORDS)}' as int)",
    "named": "cast(c.tail rlike '^[=:].' or (c.tail rlike '^[=:]$' and c.core rlike '^[A-Za-z][A-Za-z0-9]*([_-][A-Za-z0-9]+)+$') as int)",
    "paired": "cast(c.word rlike '(AKIA|ASIA)[0-9A-Z]{16}[:,/].' as int)",
    "in_url": "cast(c.word rlike '://[^?]*$' as int)",
    "keyed": "cast(c.lead != '' as int)",
    "assigned": "cast(c.lead rlike '=' as int)",
    "quoted": "cast(c.lead rlike '[\"\\'`]$' as int)",
    "tight": "cast(c.lead rlike '[=:][\"\\'`]?$' as int)",
    "letters": "cast(c.core rlike '^[A-Za-z]+$' as int)",
    "punctuation": "regexp_count(c.core, '[^A-Za-z0-9+/_=-]') / length(c.core)",
    "code": "cast(c.core rlike '^[$%{]|[(){}\\\\[\\\\]]|^(?i:true|false|null|none|nil|undefined|string|str|int|bool|yes|no|required|optional|enabled|disabled|unknown|empty|env|self|basic|bearer|oauth2?)$' as int)",
    "path_test": "cast(coalesce(lower(c.path), '') rlike '(test|example|sample|fixture|mock|docs?/|readme)' as int)",
}


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is worked out once a row, even if later columns use it in every element of an array: the generator keeps the optimizer from copying it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def behind(c: str = "c") -> str:
    """SQL for the text that must stand before a candidate to tell it from a word of prose; '' if its own form does."""
    return f"IF({c}.lead = '' OR length({c}.core) >= {LEAST} OR (length({c}.core) >= 8 AND {c}.core rlike '[A-Za-z]' AND {c}.core rlike '[^A-Za-z]'), '', {c}.lead)"


def candidates(docs: DataFrame, text: str = "text", path: str | None = "source", vocabulary: str | None = None) -> DataFrame:
    """docs with _candidates, an array of structs with core, the words beside it, and features f (array<double>).  vocabulary: file of the dictionary."""
    words, table_ = lexicon(vocabulary)
    symbol = lambda x: f"IF({x} >= '0' AND {x} <= '9', {SYMBOLS - 1}, instr('{LETTERS}', {x}))"
    steps = f"transform(sequence(2, greatest(length(n.core), 2)), i -> IF(i > length(n.core), 0D, get({table_}, {symbol('substr(n.core, i - 1, 1)')} * {SYMBOLS} + {symbol('substr(n.core, i, 1)')})))"
    where = f"`{path}`" if path else "cast(null as string)"
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    marked = F.regexp_replace(F.translate(F.col(text), EDGE + LEAD, "\n\n"), CANDIDATE, f"{EDGE}$1$3$5{LEAD}$2$4$6$7{EDGE}")
    cut = once(  # what is between candidates at even places, candidates at odd ones
        docs,
        "_parts",
        F.when(F.col(text).rlike(CANDIDATE), F.split(marked, EDGE)),
    )
    near = once(cut, "_near", F.expr(f"""transform(filter(sequence(1, size(_parts) - 1), i -> i % 2 = 1), i -> named_struct('lead', substring_index(_parts[i], '{LEAD}', 1), 'core', substring_index(_parts[i], '{LEAD}', -1),
        'left', split(concat(IF(i > 1, replace(right(_parts[i - 2], {NEAR}), '{LEAD}', ''), ''), right(_parts[i - 1], {NEAR}), substring_index(_parts[i], '{LEAD}', 1)), {quoted(CUT)}),
        'right', split(concat(left(_parts[i + 1], {NEAR}), replace(left(coalesce(get(_parts, i + 2), ''), {NEAR}), '{LEAD}', '')), {quoted(CUT)})))"""))
    found = once(
        near,
        "_found",
        F.expr(f"transform(_near, n -> named_struct('lead', n.lead, 'core', n.core, 'word', concat(element_at(n.left, -1), n.core), 'before', get(n.left, size(n.left) - 2), 'before2', get(n.left, size(n.left) - 3), 'tail', n.right[0], 'after', get(n.right, 1), 'path', {where}, 'steps', {steps}))"),
    )
    features = ", ".join(f"cast({x} as double)" for x in FEATURES.values()).replace("{words}", words)
    return once(
        found,
        "_candidates",
        F.expr(f"transform(_found, c -> named_struct('core', c.core, 'lead', {behind()}, 'f', array({features})))"),
    ).drop("_parts", "_near", "_found")


def example_findings(spark: SparkSession, n: int = EXAMPLES) -> DataFrame:
    """text, path, label, secret: findings made by rule, about half of them secrets; secret is null where all candidates have the label."""
    rows = spark.range(n).select(
        F.col("id"),
        F.sha2(F.concat(F.lit("finding "), F.col("id").cast("string")), 256).alias("h"),
        F.sha2(F.concat(F.lit("beside "), F.col("id").cast("string")), 256).alias("g"),
    )
    word = lambda a, n: f"translate(substr(g, {a}, {n}), '0123456789abcdef', 'aeioustnrlmdcphg')"
    common = ", ".join(f"'{w}'" for w in dictionary(most=400))
    real = lambda a: f"element_at(array({common}), cast(1 + conv(substr(g, {a}, 4), 16, 10) % 400 as int))"
    letters = "translate(upper(h), '0123456789ABCDEF', 'QZ2R4K7MAXBJCWEP')"
    mixed = "translate(base64(unhex(h)), '+/=', 'xY9')"
    made = [  # label, text; a tuple of (before, secret, after) is a secret among other candidates
        (1, "concat('token = \"', substr(h, 1, 40), '\"')"),
        (1, "concat('password=', substr(h, 1, 16 + cast(conv(substr(g, 60, 1), 16, 10) as int)))"),
        (1, f"concat('AKIA', substr({letters}, 1, 16))"),
        (1, f"concat('api_key: ', substr({mixed}, 1, 32))"),
        (1, "concat('secret ', substr(h, 1, 32))"),
        (1, f"concat('ghp_', substr({mixed}, 1, 36))"),
        (1, f"concat('Authorization: Bearer ', substr({mixed}, 1, 40))"),
        (1, f"concat('pwd: ', substr({mixed}, 1, 14))"),
        (1, "upper(concat('token = \"', substr(h, 1, 40), '\"!!'))"),
        (1, "concat('passwd = ', substr(h, 1, 12), '7', '###')"),
        (1, f"concat('aws ', 'AKIA', substr({letters}, 20, 16), '***')"),
        (1, f"concat('auth_token=', substr({mixed}, 3, 24))"),
        (0, "substr(translate(h, 'abcdef', '314159'), 1, 16)"),
        (0, "concat('commit ', substr(h, 1, 40))"),
        (0, "concat('sha256: ', h)"),
        (0, "concat('md5 = ', substr(h, 1, 32))"),
        (0, "concat(substr(h, 1, 8), '-', substr(h, 9, 4), '-', substr(h, 13, 4), '-', substr(h, 17, 4), '-', substr(h, 21, 12))"),
        (0, "concat('token = \"your_token_here_', substr(h, 1, 1), '23\"')"),
        (0, "concat('password=changeme', substr(translate(h, 'abcdef', '314159'), 1, 5))"),
        (0, "concat('api_key=xxxxxxxxxxxx', substr(translate(h, 'abcdef', '314159'), 1, 2))"),
        (0, f"concat({word(1, 6)}, {word(9, 7)}, '2', {word(20, 4)})"),
        (0, "concat('2024-0', 1 + id % 9, '-1', id % 9, 'T12-30-', 10 + id % 49)"),
        (0, f"concat('src/main/', {word(3, 5)}, '/util', id % 9, '/')"),
        (0, f"concat('order ', upper({word(4, 3)}), '-2023-', substr(translate(h, 'abcdef', '314159'), 1, 8))"),
        (0, f"concat('token = \"session', {word(30, 6)}, id % 9, '\"')"),
        (1, ("concat('OAUTH2_CLIENT_SECRET', element_at(array('=', ': ', '=\"'), cast(1 + id % 3 as int)))", "substr(h, 1, 32)", "''")),
        (1, (f"concat('S3_', upper({word(2, 5)}), '_ACCESS_KEY=')", f"substr({mixed}, 1, 40)", "''")),
        (
            1,
            (
                "concat('https://h', substr(h, 60, 2), '.io/api/v', id % 9, '/', " + word(2, 5) + ", '/items?token=')",
                f"concat('ghp_', substr({mixed}, 1, 36))",
                "'&page=2'",
            ),
        ),
        (1, f"concat('AKIA', substr({letters}, 1, 16), ':', substr({mixed}, 1, 40))"),  # both are secrets
        (1, ("concat('client_id=', substr(g, 1, 20), '&client_secret=')", "substr(h, 1, 32)", "''")),
        (1, f"concat('eyJ', substr({mixed}, 1, 18), '.eyJ', substr({mixed}, 9, 30), '.', translate(substr({mixed}, 2, 40), 'xY', '_-'))"),
        (
            1,
            f"concat(element_at(array('password=', 'passwd: ', 'db_password = \"'), cast(1 + id % 3 as int)), {word(1, 7)}, {word(9, 5)}, {word(18, 7)}, {word(27, 6)})",
        ),
        (
            1,
            f"concat(element_at(array('password=', 'pwd=', 'PASSWORD: '), cast(1 + id % 3 as int)), initcap({word(1, 3)}), id % 10, {word(5, 2)}, id % 7, {word(9, 3)}, element_at(array('&', '!', '$', '#', '@'), cast(1 + id % 5 as int)), id % 9)",
        ),
        (1, f"concat(element_at(array('password=', 'pwd: ', 'secret='), cast(1 + id % 3 as int)), {word(1, 4)}, id % 1000)"),
        (1, f"concat('password=', {word(1, 4)}, {word(9, 3)})"),
        (1, f"concat('passphrase = \"', {word(1, 6)}, ' ', {word(9, 5)}, ' ', {word(18, 7)}, ' ', {word(27, 4)}, '\"')"),
        (1, f"concat('passphrase = \"', {real(1)}, ' ', {real(6)}, ' ', {real(11)}, ' ', {real(16)}, '\"')"),
        (1, f"concat(element_at(array('password=', 'passwd: '), cast(1 + id % 2 as int)), {real(1)}, {real(6)}, {real(11)}, {real(16)})"),
        (0, f"concat('the ', element_at(array('secret: ', 'password: ', 'token: '), cast(1 + id % 3 as int)), {real(1)}, ' ', {real(6)})"),
        (1, f"concat('sk_live_', {word(1, 8)}, {word(9, 8)})"),
        (1, f"concat(element_at(array('xoxb-', 'glpat-', 'sk-', 'gho_'), cast(1 + id % 4 as int)), {word(1, 8)}, {word(9, 8)})"),
        (0, f"concat(element_at(array('the secret: ', 'password: ', 'a token: '), cast(1 + id % 3 as int)), {word(1, 5)})"),
        (
            0,
            "concat(element_at(array('token: ', 'password=', 'auth = ', 'secret: '), cast(1 + id % 4 as int)), element_at(array('string', 'true', 'null', 'none', 'required'), cast(1 + id % 5 as int)))",
        ),
        (
            0,
            f"concat(element_at(array('password=', 'token: ', 'secret = '), cast(1 + id % 3 as int)), element_at(array('${{', '$', '{{{{'), cast(1 + id % 3 as int)), upper({word(1, 6)}), '}}')",
        ),
        (0, f"concat('token = get_', {word(1, 5)}, '(', {word(9, 4)}, ')')"),
        (0, "concat(element_at(array('max_tokens=', 'tokens: '), cast(1 + id % 2 as int)), id % 9999)"),
        (
            0,
            "concat(element_at(array('token_ttl=', 'secret_version: ', 'auth_timeout = ', 'n_tokens='), cast(1 + id % 4 as int)), conv(substr(h, 1, 3), 16, 10))",
        ),
        (
            0,
            "concat(element_at(array('password=', 'password: \"', 'secret='), cast(1 + id % 3 as int)), element_at(array('changeme', 'your_password', 'example', 'xxxxxxxx'), cast(1 + id % 4 as int)))",
        ),
        (0, f"concat('sk-', {word(1, 3)})"),
        (0, "concat('https://www.', " + word(2, 6) + ", '.com/', " + word(12, 5) + ", '/', id % 9999, '/', " + word(20, 7) + ", '?page=', id % 99)"),
        (0, "concat('AKIAEXAMPLE', substr(translate(h, 'abcdef', '314159'), 1, 5), 'KEY')"),
    ]
    case = lambda xs: f"CASE id % {len(made)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(xs)) + " END"
    kinds = case("concat(" + ", ".join(x) + ")" if isinstance(x, tuple) else x for _, x in made)
    secret = case(x[1] if isinstance(x, tuple) else "cast(null as string)" for _, x in made)
    label = case("1.0D" if y else "0.0D" for y, _ in made)
    path = "element_at(array('src0', 'web/page', 'tests/unit', 'src/app', 'news', 'readme'), cast(1 + conv(substr(g, 50, 1), 16, 10) as int) % 6 + 1)"
    return rows.select(
        F.expr(f"concat({word(1, 5)}, ' ', {word(12, 7)}, ' ', {kinds}, ' ', {word(33, 6)}, '. ', {word(41, 4)})").alias("text"),
        F.expr(path).alias("path"),
        F.expr(label).alias("label"),
        F.expr(secret).alias("secret"),
    )


def forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH):
    """A random forest of labelled findings (text, path, label and, where a text has other candidates, secret)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    own = F.col("label") if "secret" not in labelled.columns else F.when(
        F.col("secret").isNull() | (F.col("secret") == F.col("c.core")),
        F.col("label"),
    ).otherwise(0.0)
    rows = candidates(labelled, path="path").select("*", F.explode("_candidates").alias("c")).select(
        own.alias("label"),
        array_to_vector("c.f").alias("features"),
    )
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=3, featureSubsetStrategy="sqrt", subsamplingRate=0.8).fit(rows)


def forest_sql(model, f: str = "c.f") -> str:
    """The mean probability of a secret over all trees, as SQL over an array of features."""

    def tree(node) -> str:
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            return f"{stats[1] / max(1e-9, sum(stats))!r}D"
        split = node.split()
        return f"IF({f}[{split.featureIndex()}] <= {split.threshold()!r}D, {tree(node.leftChild())}, {tree(node.rightChild())})"

    roots = [t._call_java("rootNode") for t in model.trees]
    return "(" + " + ".join(tree(r) for r in roots) + f") / {len(roots)}"


def rule(core: str = "c.core") -> str:
    """SQL for the kind of a finding."""
    return f"CASE WHEN {core} rlike '^(AKIA|ASIA)' THEN 'cloud_key' WHEN {core} rlike '{PREFIX}' THEN 'service_token' WHEN {core} rlike '^[0-9a-fA-F]+$' THEN 'hex_secret' ELSE 'secret' END"


#: What x stands behind; only '' where one of its places needs nothing before it.
LEADS = "IF(exists(_all, s -> s.secret = x AND s.lead = ''), array(''), array_distinct(transform(filter(_all, s -> s.secret = x), s -> s.lead)))"


def with_secrets(docs: DataFrame, score: str, threshold: float = THRESHOLD, path: str | None = "source") -> DataFrame:
    """docs with _secrets: array of (secret, rule, score, leads), distinct in a text, in order of place."""
    scored = once(
        candidates(docs, path=path),
        "_scored",
        F.expr(f"filter(transform(_candidates, c -> named_struct('secret', c.core, 'rule', {rule()}, 'score', {score}, 'lead', c.lead)), s -> s.score >= {threshold}D)"),
    )
    blocks = F.when(
        F.col("text").contains("PRIVATE KEY"),
        F.expr("transform(regexp_extract_all(text, '" + BLOCK.replace(
            "\\",
            "\\\\",
        ) + "', 0), b -> named_struct('secret', b, 'rule', 'private_key', 'score', 1.0D, 'lead', ''))"),
    )
    kind = "array<struct<secret:string,rule:string,score:double,lead:string>>"
    all_ = F.concat(F.coalesce(blocks.cast(kind), F.array().cast(kind)), F.coalesce(F.col("_scored").cast(kind), F.array().cast(kind)))
    # the same secret beside different words may have several scores: the best counts
    named = once(
        once(scored, "_all", all_),
        "_secrets",
        F.expr(f"transform(array_distinct(transform(_all, s -> s.secret)), x -> named_struct('secret', x, 'rule', element_at(filter(_all, s -> s.secret = x), 1).rule, 'score', array_max(transform(filter(_all, s -> s.secret = x), s -> s.score)), 'leads', {LEADS}))"),
    )
    return named.drop("_candidates", "_scored", "_all")


def learnt(spark: SparkSession, labelled: DataFrame | None = None) -> str:
    """The forest of labelled findings, or of the examples, as SQL."""
    score = forest_sql(forest(example_findings(spark) if labelled is None else labelled))
    settled(spark)
    return score


def findings(docs: DataFrame, labelled: DataFrame | None = None, path: str | None = "source") -> DataFrame:
    """A row per document and secret: doc_id, rule, start (from 0), length, occurrences, secret_sha256, score."""
    own = docs.select("doc_id", "text", *([path] if path else []))
    rows = with_secrets(own, learnt(docs.sparkSession, labelled), path=path).filter("size(_secrets) > 0").select(
        "doc_id",
        F.col("text").alias("_whole"),
        "_secrets",
        F.explode("_secrets").alias("s"),
    )
    # what is inside a longer secret is no place of a shorter one
    longer = "filter(_secrets, o -> length(o.secret) > length(s.secret) AND contains(o.secret, s.secret))"
    blank = f"aggregate({longer}, _whole, (t, o) -> aggregate(o.leads, t, (u, l) -> replace(u, concat(l, o.secret), concat(l, repeat('{EDGE}', length(o.secret))))))"
    rows = rows.withColumn("text", F.expr(blank))
    places = F.expr("aggregate(s.leads, 0L, (n, l) -> n + (length(text) - length(replace(text, concat(l, s.secret), ''))) div length(concat(l, s.secret)))")
    first = F.expr("array_min(transform(s.leads, l -> instr(text, concat(l, s.secret)) + length(l)))") - 1
    return rows.select(
        "doc_id",
        F.col("s.rule").alias("rule"),
        first.cast("long").alias("start"),
        F.length("s.secret").cast("long").alias("length"),
        places.cast("long").alias("occurrences"),
        F.sha2(F.col("s.secret"), 256).alias("secret_sha256"),
        F.col("s.score").alias("score"),
    )


def redacted(docs: DataFrame, labelled: DataFrame | None = None, mark: str = "[SECRET]", path: str | None = "source") -> DataFrame:
    """docs with every secret replaced by a mark and n_chars stated anew where it changed; the columns stay as they are."""
    own = docs.select(F.struct("*").alias("_row"), "text", *([path] if path else []))  # whatever else docs have stays out of the way
    rows = with_secrets(own, learnt(docs.sparkSession, labelled), path=path)
    changed = F.size("_secrets") > 0
    out = rows.withColumn(
        "_new",
        F.when(
            changed,
            F.expr(f"aggregate(array_sort(_secrets, (a, b) -> length(b.secret) - length(a.secret)), text, (t, s) -> aggregate(s.leads, t, (u, l) -> replace(u, concat(l, s.secret), concat(l, '{mark}'))))"),
        ).otherwise(F.col("text")),
    )
    new = {
        "text": F.col("_new"),
        "n_chars": F.when(changed, F.length("_new").cast("long")).otherwise(F.col("_row.n_chars")) if "n_chars" in docs.columns else None,
    }
    return out.select(*((new[c] if c in new else F.col("_row")[c]).alias(c) for c in docs.columns))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: kind, place, number and digest."""
    return findings(table(spark, sf_dir, "documents"))
