"""Secret scan with a random forest that removes false findings, with DataFrame functions only.

1. **Candidates.**  Every run of twelve or more key characters (letters, digits,
   `+/_-`, with dots in web tokens) of every word; a word can hold several.  And whatever stands in a
   credential's place, of any characters and four of them at least: the quoted or bare value after a credential's
   name and `=` or `:`, also when that name is the word before, and the password of an address.
2. **Features** of a candidate: its length; transitions between character classes;
   shares of digits, capitals and distinct characters; coverage by dictionary words;
   whether the word looks like a path or an address; whether the words before
   it, or the part before `=`, speak of credentials or of harmless numbers; whether
   it is itself the name that a value follows.
3. **Forest.**  ``RandomForestClassifier`` of Spark ML, trained from labelled findings.
   :func:`labelled_findings` makes such a table from documents: known secret and
   harmless formats, drawn from a hash of doc_id and text and set between words of that
   document.  A table of reviewed findings with the same columns can be used instead
   (without ``lead`` and ``tail``, they are taken from around the value's first place).

Defined cases: a NULL or blank text has no candidates; each row is scanned alone,
also with a repeated or NULL doc_id; without labelled findings of both kinds all
candidates score 0.5; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reqlens.llm.common import bounded_sample, documents, load, staged, word_array

#: Documents that lend their words to labelled findings, at most.
FINDING_DOCS = 1500
#: Formats of findings that one plan makes.
PORTION = 12
TREES = 40
DEPTH = 8
THRESHOLD = 0.5
MASK = "[SECRET]"

# A run of key characters (a web token with its dots, or any with its
# padding), words that speak of credentials or of harmless numbers, prefixes of known
# key formats, and dictionary words.
RUN = r"(?:(?<![A-Za-z0-9])(?:eyJ[A-Za-z0-9_-]{5,}|SG(?=\.))(?:\.[A-Za-z0-9_-]*){1,4}|[A-Za-z0-9+/_-]{12,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?)"
#: From the end of the run before: what lies between, and the run.
NEXT = r"(?s)\G(.*?)(" + RUN + ")"
CREDENTIAL = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|bearer|credential|private|signature)"
HARMLESS = r"(?i)(commit|sha-?\d+|md5|digest|checksum|hash|uuid|guid|isbn|issn|doi|card|phone|tel|order|invoice|ticket|version|build|rev)"
_NAME = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credentials?|private[_-]?key|signature)[A-Za-z0-9_-]*"
#: A name of a credential and its value (one group per way of quoting); the same name as a word before; an address's password.
PAIR = "(?i)" + _NAME + r"""[\"']?(?:=>|:=|[=:])(?:"([^"]{4,})"|'([^']{4,})'|([^\s"'`,;&<>{}()]{4,}))"""
NAMED_BEFORE = "(?i)" + _NAME + r"""[\"']?(?:=>|:=|[=:]| [=:])$"""
USERINFO = r"://[^\s:/@]+:([^\s/@]{4,})@"
KNOWN = r"^(AKIA|ASIA|AIza|ghp_|gho_|ghs_|glpat-|sk-|sk_live_|rk_live_|xox[abpr]-|eyJ|npm_|SG_|hf_)"
DICTIONARY = (
    "about access account address admin again and application array back base book build call change class client "
    "code color config connect content control copy count create data date day default demo dev document dummy edit "
    "end error event example export fake field file find first float form format from function get global good "
    "group hello home host house http image import index info input int item key label language last lib library "
    "line link list load local log main make manager map master message method mode model module name net new next "
    "node null number object old open option order output package page param parse password path place placeholder "
    "point port post print process product project property public query read record register release remove report "
    "request reset response result return root run sample save schema search secret select send server service "
    "session set show simple size source start state status step store stream string style system table tag target "
    "task template test text time title token total tree type update upload url user util valid value variable "
    "version view web with word work world write year your "
).split()

FEATURES = [
    "length", "runs", "digit_share", "upper_share", "lower_share", "distinct_share", "hex_only", "digits_only",
    "rises", "coverage", "slashes", "path", "address", "credential_near", "credential_here", "harmless_near",
    "assigned", "quoted", "known", "dashes", "named", "marks",
]


def _values(words: DataFrame) -> DataFrame:
    """``words`` (word, before and other columns) with a row for each candidate in the word: lead (what stands before it), tail (after it), value.

    Candidates are the word's runs, and values in a credential's place that are no run.
    """
    kept, word = words.columns, F.col("word")
    runs = words.withColumns({"gaps": F.regexp_extract_all("word", F.lit(NEXT), F.lit(1)), "runs": F.regexp_extract_all("word", F.lit(NEXT), F.lit(2))})
    bare = F.regexp_replace(word, r"""^["'`(\[]+|["'`)\],;.]+$""", "")
    pairs = F.concat(*[F.regexp_extract_all(word, F.lit(PAIR), F.lit(g)) for g in (1, 2, 3)], F.regexp_extract_all(word, F.lit(USERINFO), F.lit(1)))
    after_name = F.when(F.col("before").rlike(NAMED_BEFORE) & ~word.rlike(PAIR), F.array(bare)).otherwise(F.array().cast("array<string>"))
    in_place = F.filter(F.array_distinct(F.concat(pairs, after_name)), lambda v: (F.length(v) >= 4) & ~F.array_contains("runs", v))
    last = lambda text: F.regexp_extract(text, r"[^,;&?{}|]*$", 0)
    rest = F.regexp_replace(word, NEXT, "")

    def run(v: Column, i: Column) -> Column:
        # a name can be a run too, so the lead begins at the run before and ends its pair there
        lead = F.concat(F.when(i > 0, F.get("runs", i - 1)).otherwise(""), F.get("gaps", i))
        return F.struct(last(lead).alias("lead"), F.coalesce(F.get("gaps", i + 1), rest).alias("tail"), v.alias("value"))

    def placed(v: Column) -> Column:
        after = F.call_function("substring", word, F.call_function("instr", word, v) + F.length(v))
        return F.struct(last(F.call_function("substring_index", word, v, F.lit(1))).alias("lead"), after.alias("tail"), v.alias("value"))

    return runs.select(*kept, F.inline(F.concat(F.transform("runs", run), F.transform(in_place, placed))))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, word_no, word, before (three words), after, lead, tail, value of every candidate."""
    # exploding one array holds the words, so that no expression below splits the text again
    worded = documents(docs).select("doc_id", F.explode(F.array(word_array(F.col("text")))).alias("words"))
    likely = lambda w: ((F.length(w) >= 12) & w.rlike(RUN)) | (w.rlike("[=:]") & (w.rlike(PAIR) | w.rlike(USERINFO)))
    # the word after one that ends in = or : may be the value of a name
    follows = lambda i: F.coalesce(F.get("words", i - 1).rlike("[=:]$"), F.lit(False)) & (F.length(F.get("words", i)) >= 4)
    named = lambda i: follows(i) & F.concat_ws(" ", F.get("words", i - 2), F.get("words", i - 1)).rlike(NAMED_BEFORE)
    places = F.filter(F.transform("words", lambda w, i: F.when(likely(w) | named(i), i)), lambda i: i.isNotNull())
    found = F.transform(
        places,
        lambda i: F.struct(
            i.alias("word_no"),
            F.get("words", i).alias("word"),
            F.concat_ws(" ", F.get("words", i - 3), F.get("words", i - 2), F.get("words", i - 1)).alias("before"),
            F.coalesce(F.get("words", i + 1), F.lit("")).alias("after"),
        ),
    )
    return _values(worded.select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.*"))


def with_features(found: DataFrame) -> DataFrame:
    """``found`` (word, before, after, value, perhaps lead and tail) with a column for each of FEATURES."""
    if not {"lead", "tail"} <= set(found.columns):
        tail = F.expr("substring(word, instr(word, value) + length(value))")
        found = found.withColumns({"lead": F.regexp_extract(F.expr("substring_index(word, value, 1)"), r"[^,;&?{}|]*$", 0), "tail": tail})
    v, w = F.col("value"), F.col("word")
    n = F.greatest(F.length(v), F.lit(1))
    without = lambda pattern: F.length(F.regexp_replace(v, pattern, ""))
    # character classes written out, runs of one class drawn together
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    prefix = F.col("lead")
    words = F.lit("|".join(sorted((x for x in DICTIONARY if len(x) > 2), key=lambda x: (-len(x), x))))
    flag = lambda c: c.cast("double")
    return found.withColumns(
        {
            "length": F.length(v).cast("double"),
            "runs": F.length(classes) / n,
            "digit_share": 1 - without("[0-9]") / n,
            "upper_share": 1 - without("[A-Z]") / n,
            "lower_share": 1 - without("[a-z]") / n,
            "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / n,
            "hex_only": flag(v.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
            "digits_only": flag(v.rlike("^[0-9-]+$")),
            "rises": F.size(F.regexp_extract_all(v, F.lit("[a-z0-9][A-Z]"), F.lit(0))) / n,
            "coverage": 1 - F.length(F.regexp_replace(F.lower(v), words, F.lit(""))) / n,
            "slashes": F.size(F.regexp_extract_all(v, F.lit("/"), F.lit(0))).cast("double"),
            "path": flag(w.rlike(r"(^|[^A-Za-z0-9])([.~]{0,2}/[A-Za-z]|[A-Za-z]:\\)|\.(py|js|html?|txt|json|xml|ya?ml|c|h|java|so|jpg|png|pdf|zip|gz)\b")),
            "address": flag(w.rlike(r"://|@|www\.")),
            "credential_near": flag(F.col("before").rlike(CREDENTIAL)),
            "credential_here": flag(prefix.rlike(CREDENTIAL)),
            "harmless_near": flag(F.concat_ws(" ", "before", prefix).rlike(HARMLESS)),
            "assigned": flag(prefix.rlike("[=:]") | F.col("before").rlike("[=:]$")),
            "quoted": flag(prefix.rlike("[\"']")),
            "known": flag(v.rlike(KNOWN)),
            "dashes": F.size(F.regexp_extract_all(v, F.lit("[-_]"), F.lit(0))) / n,
            "marks": 1 - without("[^A-Za-z0-9]") / n,
            "named": flag(F.col("tail").rlike("^[\"'\\])]*[=:]")),
        }
    )


def labelled_findings(docs: DataFrame, most_docs: int = FINDING_DOCS) -> DataFrame:
    """word, before, after, lead, tail, value, label: secrets (1) and harmless look-alikes (0) between words of ``most_docs`` documents."""
    rows = documents(docs).where("text IS NOT NULL").withColumn("every", F.lit(0))
    chosen = bounded_sample(rows, "every", most_docs)
    # what is drawn hangs on id and text, as ids may repeat or be missing
    worded = chosen.select(F.xxhash64("doc_id", "text").cast("string").alias("id"), F.explode(F.array(word_array(F.col("text")))).alias("words"))
    h = lambda salt: F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id")), 256)
    b64 = lambda salt: F.regexp_replace(F.base64(F.unhex(h(salt))), "[+/=]", "x")
    upper = lambda salt: F.translate(F.upper(b64(salt)), "0189", "GHJK")
    part = lambda salt, size: F.substring(h(salt), 1, size)
    digits = lambda salt, size: F.substring(F.translate(h(salt), "abcdef", "314159"), 1, size)
    # each word of the text that a slot's hash picks
    pick = lambda salt: F.coalesce(F.get("words", F.pmod(F.xxhash64(F.lit(salt), "id"), F.greatest(F.size("words"), F.lit(1))).cast("int")), F.lit("and"))
    one_of = lambda salt, *x: F.get(F.array(*map(F.lit, x)), F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(x))).cast("int"))
    join = F.concat
    caps = lambda salt, size: F.substring(F.translate(F.upper(b64(salt)), "0123456789", "GHJKLMNPQR"), 1, size)
    plain = lambda *salts: F.regexp_replace(F.lower(join(*map(pick, salts))), "[^a-z]", "")
    key40 = lambda salt: F.substring(F.translate(F.base64(F.unhex(h(salt))), "=", "x"), 1, 40)
    jwt = lambda salt: join(F.lit("eyJ"), F.substring(b64(salt), 1, 33), F.lit(".eyJ"), F.substring(b64(salt + "2"), 1, 40), F.lit("."), b64(salt + "3"))
    secret_name = lambda salt: one_of(salt, "aws_secret_access_key", "AWS_SECRET_ACCESS_KEY", "access_token", "client_secret", "CLIENT_SECRET", "DB_PASSWORD", "API_TOKEN", "auth_token")
    plain_name = lambda salt: one_of(salt, "document_identifier", "CONTENT_DIGEST", "commit_reference", "category_name", "order_number", "displayName")
    slots = [  # label, words before, text around the value, value
        (1, None, ("", ""), join(F.lit("AKIA"), F.substring(upper("a"), 1, 16))),
        (1, one_of("k0", "key", "access_key", "id"), ("", ""), join(one_of("p0", "AKIA", "ASIA"), F.substring(upper("b"), 1, 16))),
        (1, None, ("password=", ""), part("c", 18)),
        (1, None, ("passwd:", ""), F.substring(b64("d"), 1, 20)),
        (1, F.lit("token ="), ('"', '"'), part("e", 40)),
        (1, join(one_of("k1", "secret", "token", "api_key", "auth_token"), one_of("k2", " =", ":")), ("'", "'"), F.substring(b64("f"), 1, 32)),
        (1, None, ("", ""), join(F.lit("ghp_"), F.substring(b64("g"), 1, 36))),
        (1, None, ("secret=", ""), part("h", 32)),
        (1, F.lit("Bearer"), ("", ""), join(F.lit("eyJ"), F.substring(b64("i"), 1, 36))),
        (1, None, ("", ""), join(one_of("p1", "sk-", "sk_live_", "hf_", "npm_"), F.substring(b64("j"), 1, 30))),
        (0, None, ("", ""), digits("k", 16)),
        (0, one_of("k3", "card", "phone", "order", "invoice"), ("", ""), digits("l", 14)),
        (0, one_of("k4", "commit", "sha1", "rev"), ("", ""), part("m", 40)),
        (0, one_of("k5", "sha256:", "md5", "checksum", "digest ="), ('"', '"'), part("n", 64)),
        (0, one_of("k6", "uuid", "id", "guid:"), ("", ""), F.regexp_replace(part("o", 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")),
        (0, None, ("", ""), join(F.lit("/usr/lib/"), pick("q1"), F.lit("/"), pick("q2"), F.lit("/file2"))),
        (0, None, ("", ""), join(F.lit("getUser"), F.initcap(pick("q3")), F.lit("NameFromConfig2"))),
        (0, F.lit("password"), ("=", ""), F.lit("your_password_here1")),
        (0, F.lit("token ="), ('"', '"'), one_of("p2", "example-token-123", "xxxxxxxxxxxxxxxx0", "PLACEHOLDER_VALUE", "test_test_test_1")),
        (0, None, ("https://www.example.com/", ""), join(pick("q4"), F.lit("/item-view/2020-10-12"))),
        (0, None, ("", ""), join(pick("q5"), F.lit("-"), pick("q6"), F.lit("-"), pick("q7"), F.lit("2"))),
        (0, None, ("", "@mail.example.com"), join(pick("q8"), F.lit("-name-and-"), digits("r", 4))),
        # long names, web tokens, keys without a digit, passphrases of letters
        (1, None, (join(secret_name("n1"), one_of("n2", "=", ":", '="')), one_of("n2", "", "", '"')), key40("s1")),
        (1, None, (one_of("n3", "aws_access_key_id=", "AWS_ACCESS_KEY_ID=", ""), ""), join(F.lit("AKIA"), caps("s2", 16))),
        (1, None, (join(secret_name("n4"), F.lit("=")), ""), part("s3", 32)),
        (1, one_of("k7", "Bearer", "token:", "header"), ("", ""), jwt("s4")),
        (1, None, (one_of("n5", "access_token=", "id_token=", ""), ""), jwt("s5")),
        (1, None, (one_of("n6", "password=", "passwd:", "DB_PASSWORD="), ""), join(plain("q9", "qa", "qb"), F.lit("battery"), plain("qc"))),
        # plain long words and names
        (0, None, ("", one_of("n7", "", ",", ".")), join(plain("qd", "qe"), one_of("n8", "ization", "keiten", "mente", "ement"), plain("qf"))),
        (0, None, ("", one_of("n9", "", ",", ":")), F.initcap(join(plain("qg", "qh"), F.lit("schaften"), plain("qi")))),
        (0, one_of("k8", "the password", "a secret", "token", "private"), ("", ""), join(plain("qj", "qk"), F.lit("ization"), plain("ql"))),
        (0, None, ("", ""), F.upper(join(plain("qm", "qn"), F.lit("ABILITY"), plain("qo")))),
        (0, None, ("", ""), F.upper(join(plain("qp"), F.lit("_"), plain("qq"), F.lit("_DEFAULT_"), plain("qr")))),
        (0, None, ("", ""), join(plain("qs"), F.lit("-"), plain("qt"), one_of("na", "-and-", "/", "-to-"), plain("qu"), F.lit("-like"))),
        (0, None, ("", ""), one_of("nb", "------------", "____________________", "////////////////", "-----------------------------")),
        (0, None, (join(plain_name("nc"), one_of("nd", "=", ":", '="')), one_of("nd", "", "", '"')), part("s6", 40)),
        (0, None, (join(plain_name("ne"), F.lit("=")), ""), join(plain("qv", "qw"), F.lit("description"))),
        (0, None, (join(F.lit("https://www.example.com/search/"), plain("qx"), F.lit("?"), plain_name("nf"), F.lit("=")), ""), join(plain("qy"), F.lit("-"), plain("qz"), F.lit("-example-page"))),
        (0, None, ("", ""), F.lit("www.example.com/international-news/")),
        # whatever characters a password has, in a credential's place
        (1, None, (join(secret_name("o1"), F.lit("=")), ""), join(F.initcap(plain("r1")), one_of("o2", "@", "!", "#", "$", "&", "."), digits("u1", 4), F.substring(b64("u2"), 1, 2))),
        (1, None, (one_of("o3", "password=", "passwd:", "pwd="), ""), join(F.substring(b64("u3"), 1, 4), one_of("o4", "@", "!", "$", "&"), F.substring(b64("u4"), 1, 6), one_of("o5", "", "!", "9"))),
        (1, one_of("o6", "password:", "token =", "secret:", "passwd:", "my password:"), ("", ""), join(F.substring(plain("r2", "r3"), 1, 6), digits("u5", 1), F.substring(plain("r4", "r5"), 1, 3))),
        (1, one_of("o7", "password:", "pwd =", "secret:"), ("", one_of("o8", "", ",", ".")), join(F.substring(b64("u6"), 1, 5), one_of("o9", "!", "%", "*", "?"), F.substring(b64("u7"), 1, 4))),
        (1, None, (one_of("p3", 'api_key="', 'secret="', 'auth_token:"'), '"'), join(F.substring(b64("u8"), 1, 4), F.lit("."), F.substring(b64("u9"), 1, 3), one_of("p4", "$", "!", "~", "^"), F.substring(b64("ua"), 1, 6))),
        (1, None, (one_of("p5", "postgres://admin:", "https://user:", "mysql://root:"), "@db.example.com/main"), join(F.substring(b64("ub"), 1, 6), digits("uc", 2), one_of("p6", "", "!", "$"), F.substring(b64("ud"), 1, 3))),
        (0, one_of("p7", "password:", "token:", "secret:", "a password:", "auth ="), ("", one_of("p8", "", ",", ".")), pick("r6")),
        (0, one_of("p9", "password:", "token =", "secret:"), ("", ""), F.initcap(plain("r7", "r8"))),
        (0, None, (one_of("pa", "password=", "token=", "secret:", "api_key=", "auth="), ""), one_of("pb", "none", "null", "true", "false", "required", "changeme", "disabled", "optional", "basic", "unknown", "example")),
        (0, None, (one_of("pc", "password=", "token=", "secret="), ""), one_of("pd", "********", "xxxxxxxx", "$PASSWORD", "$TOKEN", "[hidden]", "....", "%s%s", "----", "[SECRET]")),
        (0, None, (one_of("pe", "password=", "token:", "auth="), ""), plain("r9", "ra")),
        (0, None, (one_of("pf", 'password="', 'token="', "secret='"), one_of("pf", '"', '"', "'")), one_of("pg", "enter password", "password", "your token", "value")),
    ]
    several = [  # label of each value, texts around the values, values
        ((1, 1), ('{"access_token":"', '","client_secret":"', '"}'), (key40("t1"), part("t2", 32))),
        ((1, 1), ("https://api.example.com/v1/item?access_token=", "&client_secret=", ""), (part("t3", 40), F.substring(b64("t4"), 1, 32))),
        ((1, 1), ("DB_PASSWORD=", ";API_TOKEN=", ""), (F.substring(b64("t5"), 1, 20), part("t6", 32))),
        ((1, 1), ("AWS_ACCESS_KEY_ID=", ",AWS_SECRET_ACCESS_KEY=", ""), (join(F.lit("AKIA"), caps("t7", 16)), key40("t8"))),
        ((1, 1), ("", ":", ""), (join(F.lit("AKIA"), F.substring(upper("t9"), 1, 16)), key40("ta"))),
        ((0, 1), ('{"commit":"', '","client_secret":"', '"}'), (part("tb", 40), key40("tc"))),
        ((1, 0), ('{"auth_token":"', '","document_digest":"', '"}'), (part("td", 32), part("te", 40))),
        ((0, 0), ('{"document_identifier":"', '","content_checksum":"', '"}'), (digits("tf", 16), part("tg", 64))),
        ((0, 0), ("https://www.example.com/view?category_name=", "&invoice_number=", ""), (join(plain("th"), F.lit("description")), digits("ti", 14))),
    ]
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    parts = [((label,), around, (value,), lead) for label, lead, around, value in slots] + [(*s, None) for s in several]
    made = [
        F.struct(
            join(text(around[0]), *[x for v, a in zip(values, around[1:], strict=True) for x in (v, text(a))]).alias("word"),
            F.concat_ws(" ", pick(f"b{i}"), *([lead] if lead is not None else [pick(f"c{i}"), pick(f"d{i}")])).alias("before"),
            pick(f"e{i}").alias("after"),
            F.array(*[F.when(F.lit(bool(y)), v) for y, v in zip(labels, values, strict=True)]).alias("secrets"),
        )
        for i, (labels, around, values, lead) in enumerate(parts)
    ]
    # staged: a bounded table, whose many formats are made once, and in portions, as one plan of all takes much of the driver's memory
    worded = staged(worded)
    portions = [made[i : i + PORTION] for i in range(0, len(made), PORTION)]
    rows = reduce(DataFrame.unionByName, [staged(worded.select("id", F.explode(F.array(*x)).alias("f")).select("id", "f.*")) for x in portions])
    # every run of a made word is a finding: its secrets are, names and all else are not
    return _values(rows).withColumn("label", F.exists("secrets", lambda v: F.coalesce(v == F.col("value"), F.lit(False))).cast("int")).drop("secrets")


def train(findings: DataFrame, trees: int = TREES, depth: int = DEPTH):
    """A forest from labelled findings, or None without both labels."""
    # a bounded table that the fit reads several times
    rows = staged(with_features(findings).select("label", *FEATURES))
    seen = {r.label for r in rows.groupBy("label").agg(F.count(F.lit(1))).collect()}  # two rows
    if not {0, 1} <= seen:
        return None
    # one ordered partition: the same forest on each run, from a bounded table
    ordered = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).repartition(1).sortWithinPartitions("label", *FEATURES)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=42, maxBins=64, subsamplingRate=0.8).fit(ordered)


def scan(docs: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, word_no, word, value, score, is_secret of every candidate."""
    found = with_features(candidates(docs))
    if model is None:
        scored = found.withColumn("score", F.lit(0.5))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "word_no", "word", "value", "score", (F.col("score") > threshold).alias("is_secret"))


def redacted(docs: DataFrame, found: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with each secret found under their doc_id (also under none) masked in the words that hold it."""
    longest = lambda c: F.sort_array(F.collect_set(c), asc=False)
    sized = lambda c: F.struct(F.length(c).alias("n"), F.col(c).alias("v"))
    words = found.where("is_secret").groupBy(F.col("doc_id").alias("_of"), "word").agg(longest(sized("value")).alias("_values"))
    hidden = words.withColumn("_new", F.aggregate("_values", F.col("word"), lambda w, x: F.replace(w, x["v"], F.lit(mask))))
    of_doc = hidden.groupBy("_of").agg(longest(F.struct(F.length("word").alias("n"), "word", "_new")).alias("_words"))
    joined = docs.join(of_doc, docs["doc_id"].eqNullSafe(of_doc["_of"]), "left")
    text = F.when(
        F.col("_words").isNotNull(), F.aggregate("_words", docs["text"], lambda t, x: F.replace(t, x["word"], x["_new"]))
    ).otherwise(docs["text"])
    return joined.select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = scan(docs, train(labelled_findings(docs)))
    return found.select("doc_id", "word_no", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")
