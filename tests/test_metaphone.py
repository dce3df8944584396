"""Double metaphone against published codes of words."""

from pyspark.sql import functions as F

from trawl.functions.analysis import ALT
from trawl.functions.metaphone import TABLE, double_metaphone, phonetic_codes
from trawl.functions.profiles import PROFILES

# Words with their published primary and secondary codes.
PUBLISHED = """
    testing TSTN TSTN; the 0 T; quick KK KK; brown PRN PRN; fox FKS FKS; jumped JMPT AMPT; over AFR AFR; lazy LS LS;
    dogs TKS TKS; MacCafferey MKFR MKFR; Stephan STFN STFN; Kuczewski KSSK KXFS; McClelland MKLL MKLL;
    xenophobia SNFP SNFP; Fokker FKR FKR; Joqqi JK AK; Hovvi HF HF; Czerny SRN XRN; smith SM0 XMT; schmidt XMT SMT;
    thumb 0M TM; thomas TMS TMS; wright RT RT; knight NT NT; caesar SSR SSR; character KRKT KRKT; michael MKL MXL;
    jose HS HS; cabrillo KPRL KPR; arnow ARN ARNF; filipowicz FLPT FLPF; breaux PR PR; zhao J J; edge AJ AJ;
    edgar ATKR ATKR; laugh LF LF; cough KF KF; McLaughlin MKLF MKLF; bough P P; tagliaro TKLR TLR; biaggi PJ PK;
    bellocchio PLX PLX; bacci PX PX; accident AKST AKST; succeed SKST SKST; resnais RSN RSNS; artois ART ARTS;
    rogier RJ RJR; hochmeier HKMR HKMR; hugh H H; sugar XKR SKR; island ALNT ALNT; school SKL SKL;
    schermerhorn XRMR SKRM; schenker XNKR SKNK; snider SNTR XNTR; womo AM FM; ghislane JLN JLN; ghiradelli JRTL JRTL;
    cagney KKN KKN; bajador PJTR PHTR; nation NXN NXN; chianti KNT KNT; wachtler AKTL FKTL; dumb TM TM;
    campbell KMPL KMPL
"""


def test_published_codes(spark):
    words = [tuple(entry.split()) for entry in PUBLISHED.split(";")]
    out = spark.createDataFrame(words, "w string, p string, s string").select("w", "p", "s", double_metaphone(F.col("w")).alias("c"))
    assert [(r.w, r.c.primary, r.c.secondary) for r in out.collect()] == words


def test_words_without_letters_and_other_scripts(spark):
    words = ["2024", "", "日本", "a", "ñandú", "x~y", "r2d2"]
    out = spark.createDataFrame([(w,) for w in words], "w string").select(phonetic_codes(F.array("w"))[0].alias("c")).collect()
    assert [r.c for r in out] == ["2024", "", "日本", "A", "NNT", "S", "RT"]
    assert spark.range(1).select(double_metaphone(F.lit(None).cast("string"))["primary"].alias("c")).first().c is None


def test_profile_holds_both_codes_at_a_position(spark):
    out = spark.createDataFrame([("Smith and Schmidt",)], "t string").select(PROFILES["phonetic"].index(F.col("t")).alias("x")).first()
    assert list(out.x) == [f"SM0{ALT}XMT", "ANT", f"XMT{ALT}SMT"]


def test_every_place_has_a_rule():
    assert TABLE[-1].letters == "[^~]" and not any(TABLE[-1][i] for i in (0, 2, 3, 4, 5))
