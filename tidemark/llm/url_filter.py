"""URL filters: host and path rules first, then logistic regression on hashed n-grams, native.

Character n-grams of host and path are hashed into a fixed number of features;
the regression is trained from a small labelled URL table that knows nothing of the pages judged. Nothing is shuffled:
a URL is judged where it is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower
from tidemark.operators.model import make_classifier

FEATURES = 1 << 13
GRAMS = (3, 4)

# The labelled URL table. Words by label, names that say nothing and stand beside both, and the addresses
# that each word takes, at one time in the host, at one time in the path under a host that says nothing.
BLOCK_WORDS = (
    "casino slots jackpot poker lottery bets betting win prize pills meds viagra pharmacy cheap free money loans spam "
    "farm links ads adserver track tracker click banner popup adult xxx porn sex cams escort replica hack crack warez").split()
ALLOW_WORDS = (
    "university garden news city software encyclopedia museum recipes kitchen weather library school hospital travel island "
    "forum radio bank theatre maps region newspaper journal science teacher athletics station mountain parliament history "
    "street water bread house letter order health archive music church insurance village railway football cycling "
    "chemistry physics language grammar dictionary council airport harbour gallery festival orchestra lecture academy").split()
NEUTRAL_WORDS = (
    "acme lake blue maria peter delta nova studio group world web online service home team north central smith garcia mueller "
    "martin point line plus media digital global local green silver park valley bridge summit").split()
#: Invented names of two or three of these syllables; like names that mean nothing they are allowed.
SYLLABLES = "ka lo mi ru ta ven sol bri dan pe zu nor fal gim".split()
ADDRESSES = (
    "http://www.{w}.com/",
    "https://{n}-{w}.org/{m}/5120.html",
    "https://m.{w}{n}.net/p/88?page=2&ref=x",
    "ftp://files.{w}-{n}.info/2024/06/4101/",
    "http://blog.{m}-{w}-{n}.example.com/",
    "http://www.{n}.com/{w}",
    "https://{n}{m}.co.uk/{w}/{m}.html",
    "https://blog.{n}.io/view/the-{w}-{m}/?page=2&ref=x",
    "http://{n}.edu/2024/06/{w}_{m}.php",
    "http://shop.{n}.de/p/88/my-{w}/index.html",
)
#: One row in so many of the table is held out.
HELD_OUT = 5


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    action: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


#: Default rules.
RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
         Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: Rule) -> Column:
    return (((F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host)))
            & F.startswith(F.col("path"), F.lit(rule.path)))


def _first(rules: tuple[Rule, ...], value) -> Column:
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is tested first
        found = F.when(_fits(r), F.lit(value(r))).otherwise(found)
    return found


def _grams(mark: str, text: Column) -> Column:
    padded = F.concat(F.lit("^"), text, F.lit("$"))

    def of(k: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - (k - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(padded, i, F.lit(k))))

    return F.concat(*[of(k) for k in GRAMS])


def _features(urls: DataFrame) -> DataFrame:
    grams = urls.withColumn("__grams", F.concat(_grams("h:", F.col("host")), _grams("p:", F.lower("path"))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="__features").transform(grams)


def labelled_table(spark: SparkSession) -> DataFrame:
    """``url``, ``label`` (1: block), ``held_out``: every word of the two lists at every address, between two pairs of
    neutral words, and the addresses of neutral words and invented names alone, which are allowed."""
    def words(ws, label: float, salt: str):
        return [F.struct(F.lit(w).alias("w"), F.lit(label).alias("label"), F.lit(f"{salt}{i}").alias("salt")) for i, w in enumerate(ws)]

    names = [a + b + c for i, a in enumerate(SYLLABLES) for j, b in enumerate(SYLLABLES) for c in ("", SYLLABLES[(3 * i + 5 * j) % len(SYLLABLES)])]
    rows = words(BLOCK_WORDS, 1.0, "b") + words(ALLOW_WORDS, 0.0, "a") + words(NEUTRAL_WORDS, 0.0, "n") + words(names, 0.0, "s")
    neutral = F.array(*[F.lit(w) for w in NEUTRAL_WORDS])

    def pick(k: int) -> Column:
        return F.element_at(neutral, (F.pmod(F.xxhash64("salt", "address", "turn", F.lit(k)), F.lit(len(NEUTRAL_WORDS))) + 1).cast("int"))

    table = (spark.range(1).select(F.explode(F.array(*rows)).alias("x")).select("x.*")
             .withColumn("address", F.explode(F.array(*[F.lit(a) for a in ADDRESSES])))
             .withColumn("turn", F.explode(F.when(F.col("salt").rlike("^s"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1))))))
    url = F.replace(F.replace(F.replace("address", F.lit("{w}"), F.col("w")), F.lit("{n}"), pick(1)), F.lit("{m}"), pick(2))
    return table.select(url.alias("url"), "label").withColumn("held_out", F.crc32(F.col("url").cast("binary")) % HELD_OUT == 0)


def held_out_share(model: LogisticRegressionModel, labelled: DataFrame) -> DataFrame:
    """``label``, ``n``, ``right``: the held-out rows of a labelled table that the regression alone judges rightly."""
    judged = judge(labelled.where("held_out"), model, ()).withColumn("right", (F.col("verdict") == "block") == (F.col("label") == 1))
    return judged.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("right").cast("long")).alias("right"))


def train(labelled: DataFrame, ridge: float = 0.001, balance: float = 0.25) -> LogisticRegressionModel:
    """The regression from the rows of ``url``, ``label`` (1: block), ``held_out`` that are not held out. Block rows
    together weigh ``balance`` times the others: a url that says nothing is allowed."""
    fitted = labelled.where(~F.col("held_out"))
    n = fitted.agg(F.sum("label").alias("block"), F.sum(1 - F.col("label")).alias("allow")).first()
    weight = balance * (n["allow"] or 0.0) / n["block"] if n["block"] else 1.0
    rows = _features(fitted.select("label", F.when(F.col("label") == 1, weight or 1.0).otherwise(1.0).alias("weight"),
                                   host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    return make_classifier("lr", features="__features", weightCol="weight", regParam=ridge, maxIter=100, standardization=False,
                           probabilityCol="__probability", rawPredictionCol="__raw", predictionCol="__prediction").fit(rows)


def judge(urls: DataFrame, model: LogisticRegressionModel, rules: tuple[Rule, ...] = RULES, url_col: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (text of the longest fitting rule, else null),
    ``block_score`` (the regression's, always given) and ``verdict`` (the rule's, else block
    from a score of 0.5 on, else allow).

    A null url, or one without ``://``, has empty host and path; no rule fits it
    and the regression judges the empty strings. Rows, repeated ones too, and
    further columns stay; columns of the names given are replaced. An empty
    table gives an empty one.
    """
    made = {"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}
    scored = model.transform(_features(urls.withColumns(made)))
    scored = scored.withColumns({"rule": _first(rules, lambda r: r.text), "block_score": vector_to_array("__probability")[1]})
    verdict = F.coalesce(_first(rules, lambda r: r.action), F.when(F.col("block_score") >= 0.5, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).drop("__grams", "__features", "__raw", "__probability", "__prediction")
