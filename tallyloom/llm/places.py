"""One place for each record from a city and a zip that are each misspelt, shortened or missing at times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.neighbours import deletions

# Postal short forms of the last word of a place name.
SUFFIXES = dict(
    pair.split("=")
    for pair in """BCH=BEACH BLF=BLUFF BLFS=BLUFFS BND=BEND BR=BRIDGE BRG=BRIDGE BSN=BASIN BTM=BOTTOM CP=CAMP CRK=CREEK COR=CORNER CORS=CORNERS
CV=COVE CYN=CANYON FLD=FIELD FLS=FALLS FLT=FLAT FLTS=FLATS FRK=FORK FRY=FERRY FT=FORT GDN=GARDEN GLN=GLEN GRV=GROVE GTWY=GATEWAY HBR=HARBOR
HL=HILL HLS=HILLS HOLW=HOLLOW HTS=HEIGHTS HVN=HAVEN IS=ISLAND JCT=JUNCTION JCTN=JUNCTION KNL=KNOLL LGT=LIGHT LK=LAKE LKS=LAKES LNDG=LANDING MDW=MEADOW MDWS=MEADOWS
ML=MILL MLS=MILLS MTN=MOUNTAIN NRWS=NARROWS ORCH=ORCHARD PLN=PLAIN PLNS=PLAINS PR=PRAIRIE PRT=PORT PT=POINT PTS=POINTS RCH=RANCH RDG=RIDGE RNCH=RANCH
SHR=SHORE SHRS=SHORES SMT=SUMMIT SPG=SPRING SPGS=SPRINGS SPNGS=SPRINGS STA=STATION STN=STATION TER=TERRACE TERR=TERRACE TRL=TRAIL VIS=VISTA VLG=VILLAGE VLY=VALLEY VW=VIEW WL=WELL
WLS=WELLS XING=CROSSING""".split()
)


def clean_city(city: Column, state: str = "CA") -> Column:
    """A city in upper case, without its state, with its last word written out; null if nothing is left."""
    c = F.trim(F.regexp_replace(F.upper(city), r"[^\p{L}\p{N}]+", " "))
    c = F.trim(F.regexp_replace(c, rf" {state}$", ""))
    last = F.regexp_extract(c, r"(\S+)$", 1)
    full = F.element_at(F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv]), F.when(last != "", last))
    c = F.when(full.isNotNull(), F.concat(F.regexp_replace(c, r"\S+$", ""), full)).otherwise(c)
    return F.when(c != "", c)


def zip5(code: Column) -> Column:
    """The first five digits of a zip; null if there are fewer."""
    z = F.regexp_extract(F.trim(code), r"^(\d{5})", 1)
    return F.when(z != "", z)


def place_names(records: DataFrame) -> DataFrame:
    """(zip, place): the city that most records of a zip name; the more frequent city overall, then the smaller name, on a tie."""
    named = records.filter("zip IS NOT NULL AND city IS NOT NULL").groupBy("zip", "city").agg(F.count(F.lit(1)).alias("n"))
    overall = named.groupBy("city").agg(F.sum("n").alias("all"))
    ranked = named.join(overall.hint("shuffle_hash"), "city").withColumn("r", F.row_number().over(Window.partitionBy("zip").orderBy(F.desc("n"), F.desc("all"), "city")))
    return ranked.filter("r = 1").select("zip", F.col("city").alias("place"))


def with_place(records: DataFrame, names: DataFrame) -> DataFrame:
    """records (city, zip, ...) with `place`: the zip's place; without one, the known place next to the city in spelling; else the city.

    A record without zip and city has a null place. Cities that are not known are repaired through shared deletions, two at most.
    """
    known = names.select("place").distinct()
    joined = records.join(names.withColumnRenamed("place", "by_zip"), "zip", "left")
    unknown = joined.filter("by_zip IS NULL AND city IS NOT NULL").select("city").distinct().join(known.withColumnRenamed("place", "city"), "city", "left_anti")
    variants = lambda df, c: df.select(c, F.explode(deletions(F.col(c), True)).alias("v"))
    near = (
        variants(unknown, "city")
        .hint("merge")
        .join(variants(known, "place"), "v")
        .select("city", "place", F.levenshtein("city", "place").alias("far"))
        .groupBy("city")
        .agg(F.min(F.struct("far", "place")).alias("best"))
        .select("city", F.col("best.place").alias("repaired"))
    )
    return joined.join(near, "city", "left").withColumn("place", F.coalesce("by_zip", "repaired", "city")).drop("by_zip", "repaired")
