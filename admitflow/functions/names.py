"""Names under which institutions appear in listings, and pages known to hold programme tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Names by institution; they are compared in lower case. A name that isn't here is never guessed.
INSTITUTION_NAMES = {
    "cput": ["Cape Peninsula University of Technology (CPUT)", "Cape Peninsula University of Technology", "CPUT"],
    "cut": ["Central University of Technology (CUT)", "Central University of Technology", "CUT"],
    "dut": ["Durban University of Technology (DUT)", "Durban University of Technology", "DUT"],
    "mut": ["Mangosuthu University of Technology (MUT)", "Mangosuthu University of Technology", "MUT"],
    "nmu": ["Nelson Mandela University (NMU)", "Nelson Mandela University", "NMU"],
    "nwu": ["North West University (NWU)", "North-West University (NWU)", "North-West University", "NWU"],
    "ru": ["Rhodes University (RU)", "Rhodes University", "RU"],
    "smu": ["Sefako Makgatho University (SMU)", "Sefako Makgatho Health Sciences University (SMU)", "Sefako Makgatho Health Sciences University", "SMU"],
    "spu": ["Sol Plaatje University (SPU)", "Sol Plaatje University", "SPU"],
    "su": ["Stellenbosch University (SU)", "Stellenbosch University", "SU"],
    "tut": ["Tshwane University of Technology (TUT)", "Tshwane University of Technology", "TUT"],
    "uct": ["University of Cape Town (UCT)", "University of Cape Town", "UCT"],
    "ufh": ["University of Fort Hare (UFH)", "University of Fort Hare", "UFH"],
    "ufs": ["University of Free State (UFS)", "University of the Free State (UFS)", "University of the Free State", "UFS"],
    "uj": ["University of Johannesburg (UJ)", "University of Johannesburg", "UJ"],
    "ukzn": ["University of KwaZulu Natal (UKZN)", "University of KwaZulu-Natal (UKZN)", "University of KwaZulu-Natal", "UKZN"],
    "ul": ["Limpopo University (UL)", "University of Limpopo (UL)", "University of Limpopo", "UL"],
    "ump": ["University of Mpumalanga (UMP)", "University of Mpumalanga", "UMP"],
    "unisa": ["University of South Africa (UNISA)", "University of South Africa", "UNISA"],
    "univen": ["University of Venda (UNIVEN)", "University of Venda", "UNIVEN"],
    "unizulu": ["University of Zululand (UNIZULU)", "University of Zululand", "UNIZULU"],
    "up": ["University of Pretoria (UP)", "University of Pretoria", "UP"],
    "uwc": ["University of Western Cape (UWC)", "University of the Western Cape (UWC)", "University of the Western Cape", "UWC"],
    "vut": ["Vaal University of Technology (VUT)", "Vaal University of Technology", "VUT"],
    "wits": ["University of Witwatersrand (WITS)", "University of the Witwatersrand (WITS)", "University of the Witwatersrand", "Wits"],
    "wsu": ["Walter Sisulu University (WSU)", "iYunivesithi Walter Sisulu (WSU)", "Walter Sisulu University", "WSU"],
}
#: Pages verified to hold programme tables, by document.
TABLE_PAGES = {
    "uj_2027": [32, 33, 34, 37, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 51, 54, 55, 60, 61, 62, 63, 66, 67, 68, 69, 70, 74, 75, 76, 82, 86, 87, 88, 89, 90, 91, 92, 93, 94, 95],
    "cput_2027": [7, 15],
}


def institution_names(spark: SparkSession) -> DataFrame:
    """(variant, institution_id)."""
    return spark.createDataFrame([(n, i) for i, names in INSTITUTION_NAMES.items() for n in names], "variant string, institution_id string")


def table_pages(spark: SparkSession) -> DataFrame:
    """(doc, page) of the pages known to hold programme tables."""
    return spark.createDataFrame([(d, p) for d, pages in TABLE_PAGES.items() for p in pages], "doc string, page int")
