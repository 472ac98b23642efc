"""Language codes of corpora and of the aligned evaluation sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Corpus language code, then evaluation-set code (ISO 639-3 and script).
LANGUAGES = """
ace ace_Latn, af afr_Latn, ak aka_Latn, am amh_Ethi, ar arb_Arab, as asm_Beng, ast ast_Latn,
ay ayr_Latn, az azj_Latn, azb azb_Arab, ba bak_Cyrl, bm bam_Latn, ban ban_Latn, be bel_Cyrl,
bem bem_Latn, bn ben_Beng, bho bho_Deva, bjn bjn_Latn, bo bod_Tibt, bs bos_Latn, bug bug_Latn,
bg bul_Cyrl, ca cat_Latn, ceb ceb_Latn, cs ces_Latn, cjk cjk_Latn, ckb ckb_Arab, crh crh_Latn,
cy cym_Latn, da dan_Latn, de deu_Latn, dik dik_Latn, dyu dyu_Latn, dz dzo_Tibt, el ell_Grek,
en eng_Latn, eo epo_Latn, es spa_Latn, et est_Latn, eu eus_Latn, ee ewe_Latn, fa pes_Arab,
fi fin_Latn, ff fuv_Latn, fj fij_Latn, fo fao_Latn, fon fon_Latn, fr fra_Latn, fur fur_Latn,
gd gla_Latn, ga gle_Latn, gl glg_Latn, gn grn_Latn, gu guj_Gujr, ht hat_Latn, ha hau_Latn,
he heb_Hebr, hi hin_Deva, hne hne_Deva, hr hrv_Latn, hu hun_Latn, hy hye_Armn, ig ibo_Latn,
ilo ilo_Latn, id ind_Latn, is isl_Latn, it ita_Latn, jv jav_Latn, ja jpn_Jpan, kn kan_Knda,
ka kat_Geor, kab kab_latn, kac kac_Latn, kam kam_Latn, kbp kbp_Latn, kea kea_Latn, kg kon_Latn,
ki kik_Latn, kk kaz_Cyrl, km khm_Khmr, kmb kmb_Latn, ko kor_Hang, ks-Arab kas_Arab,
ks-Deva kas_Deva, kr-Arab knc_Arab, kr-Latn knc_Latn, ku kmr_Latn, ku-Latn kmr_Latn, ky kir_Cyrl,
lb ltz_Latn, lg lug_Latn, li lim_Latn, lij lij_Latn, lmo lmo_Latn, ln lin_Latn, lo lao_Laoo,
lt lit_Latn, ltg ltg_Latn, lua lua_Latn, luo luo_Latn, lus lus_Latn, lv lvs_Latn, mag mag_Deva,
mai mai_Deva, min-Arab min_Arab, min min_Latn, mg plt_Latn, mi mri_Latn, mk mkd_Cyrl, ml mal_Mlym,
mn khk_Cyrl, mni mni_Beng, mos mos_Latn, mr mar_Deva, ms zsm_Latn, mt mlt_Latn, my mya_Mymr,
nb nob_Latn, ne npi_Deva, nl nld_Latn, nn nno_Latn, no nob_Latn, nso nso_Latn, nus nus_Latn,
ny nya_Latn, oc oci_Latn, om gaz_Latn, or ory_Orya, pag pag_Latn, pa pan_Guru, pap pap_Latn,
pl pol_Latn, prs prs_Arab, ps pbt_Arab, pt por_Latn, qu quy_Latn, rn run_Latn, ro ron_Latn,
ru rus_Cyrl, rw kin_Latn, sa san_Deva, sat sat_Olck, sc srd_Latn, scn scn_Latn, sd snd_Arab,
sg sag_Latn, shn shn_Mymr, si sin_Sinh, sk slk_Latn, sl slv_Latn, sm smo_Latn, sn sna_Latn,
so som_Latn, sq als_Latn, sr srp_Cyrl, ss ssw_Latn, st sot_Latn, su sun_Latn, sv swe_Latn,
sw swh_Latn, szl szl_Latn, ta tam_Taml, taq taq_Latn, te tel_Telu, tg tgk_Cyrl, th tha_Thai,
ti tir_Ethi, tk tuk_Latn, tl tgl_Latn, tn tsn_Latn, tpi tpi_Latn, tr tur_Latn, ts tso_Latn,
tt tat_Cyrl, tum tum_Latn, tw twi_Latn, tzm tzm_Tfng, ug uig_Arab, uk ukr_Cyrl, umb umb_Latn,
ur urd_Arab, uz uzn_Latn, vec vec_Latn, vi vie_Latn, war war_Latn, wo wol_Latn, xh xho_Latn,
yi ydd_Hebr, yo yor_Latn, yue yue_Hant, zh-CN zho_Hans, zh zho_Hans, zh-TW zho_Hant, zu zul_Latn
"""

SCHEMA = "lang string, flores_code string"


def codes() -> dict[str, str]:
    """Corpus code to evaluation-set code."""
    return dict(entry.split() for entry in LANGUAGES.split(","))


def script_of(lang: str) -> str | None:
    """Script of a corpus language, e.g. ``Latn``; None when the language is not listed."""
    code = codes().get(lang)
    return code.split("_")[1].capitalize() if code else None


def language_map(spark: SparkSession) -> DataFrame:
    """``lang, flores_code, iso3, script``: a fixed table of fewer than 200 rows, safe to broadcast."""
    table = spark.createDataFrame(list(codes().items()), SCHEMA)
    parts = F.split("flores_code", "_")
    return table.select("lang", "flores_code", parts[0].alias("iso3"), parts[1].alias("script"))


def with_language(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Add the codes of ``lang``; unlisted languages get nulls."""
    known = language_map(df.sparkSession).withColumnRenamed("lang", lang)
    return df.join(F.broadcast(known), lang, "left")
