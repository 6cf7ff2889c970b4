"""Coded answers and the texts shown for them.

Fixed values: every number and every text below must equal the clinical
dictionary of the record system; they are data, not a choice of this library.
"""

# visit types
PART_B = (1, 3)
ADULT_OPENING, ADULT_VISIT, CHILD_OPENING, CHILD_VISIT = 5, 6, 7, 9
LABORATORY = 13
PICKUP = 18
PRE_REGISTER, TREATMENT_REGISTER = 32, 33
COUNSELLING = (34, 35)
EXTERNAL_PICKUP = 52
MASTER_CARD = 53
VISITS = (6, 9)
OPENINGS = (5, 7)
VIRAL_LOAD_VISITS = (13, 6, 9)
COUNSELLING_FORM = 164

# programs
CARE, TREATMENT, TUBERCULOSIS, MATERNAL = 1, 2, 5, 8

# concepts
VIRAL_LOAD = 856
ART_MANAGEMENT, ART_START_DATE = 1255, 1190
NEXT_PICKUP, NEXT_VISIT = 5096, 1410
CD4 = 5497
REGIMEN = 1088
REFERRAL = 1594
CONTACT, CONTACT_SECOND = 1611, 6224
STAGE = 5356
PREGNANT, PREGNANCY_WEEKS, DUE_DATE, PREGNANT_CARD = 1982, 1279, 1600, 5272
DIAGNOSIS_DATE, FILE_DATE = 6123, 23891
PCR_TEST, RAPID_TEST_1, RAPID_TEST_2 = 23779, 1030, 1040
TB_SCREEN = (6257, 23758)
TB_INVESTIGATION = (6277, 23761)
INH_START, INH_END, INH_COURSE = 6128, 6129, 6122
EXTERNAL_GIVEN, EXTERNAL_DATE = 23865, 23866
CARE_MODEL = (23724, 23725, 23726, 23727, 23729, 23730, 23731, 23732, 23888)

# answers
START, COMPLETED = 1256, 1267
YES, NO, POSITIVE = 1065, 1066, 703
PREGNANT_YES, PREGNANT_ALSO = 44, 1465

# states
ACTIVE, ABANDONED, TRANSFERRED_IN = 6, 9, 29
OTHER = "OUTRO"

TREATMENT_EXITS = {7: "TRANSFERIDO PARA", 8: "SUSPENSO", 9: "ABANDONO", 10: "OBITO"}
CARE_EXITS = {2: "ABANDONO", 3: "TRANSFERIDO PARA", 4: "INICIO TARV", 5: "OBITO"}

STAGES = {1204: "I", 1205: "II", 1206: "III", 1207: "IV"}

PRE_BOOKS = {6259: "LIVRO 1", 6260: "LIVRO 2"}
TREATMENT_BOOKS = {6261: "LIVRO 1", 6262: "LIVRO 2"}

# regimens as the viral-load reports show them
REGIMENS = {
    792: "D4T+3TC+NVP",
    1651: "AZT+3TC+NVP",
    1703: "AZT+3TC+EFV",
    1827: "D4T+3TC+EFV",
    6100: "AZT+3TC+LPV/r(2ª Linha)",
    6102: "D4T+3TC+ABC",
    6103: "D4T+3TC+LPV/r",
    6105: "ABC+3TC+NVP",
    6108: "TDF+3TC+LPV/r(2ª Linha)",
    6109: "AZT+DDI+LPV/r (2ª Linha)",
    6110: "TRIOMUNE BABY",
    6116: "AZT+3TC+ABC",
    6243: "TDF+3TC+NVP",
    6324: "TDF+3TC+EFV",
    6325: "D4T+3TC+ABC+LPV/r (2ª Linha)",
    6326: "AZT+3TC+ABC+LPV/r (2ª Linha)",
    6327: "D4T+3TC+ABC+EFV (2ª Linha)",
    6328: "AZT+3TC+ABC+EFV (2ª Linha)",
    6329: "TDF+3TC+RAL+DRV/r (3ª Linha)",
    6330: "AZT+3TC+RAL+DRV/r (3ª Linha)",
}

# regimens as the differentiated-care report shows them (shared codes differ)
CARE_REGIMENS = {
    817: "ABC+3TC+AZT",
    1311: "ABC+3TC+LPV/r(2ª Linha)",
    1314: "AZT+3TC+LPV/r",
    1651: "AZT+3TC+NVP",
    1703: "AZT+3TC+EFV",
    6100: "AZT+3TC+LPV/r",
    6104: "ABC+3TC+EFV",
    6105: "ABC+3TC+NVP",
    6106: "ABC+3TC+LPV/r",
    6108: "TDF+3TC+LPV/r(2ª Linha)",
    6114: "AZT60+3TC+NVP(Douvir N Baby)",
    6116: "AZT+3TC+ABC",
    6243: "TDF+3TC+NVP",
    6324: "TDF+3TC+EFV",
    6329: "TDF+3TC+RAL+DRV/r(3ª Linha)",
    21163: "AZT+3TC+LPV/r(2ª Linha)",
    23784: "TDF+3TC+DTG",
    23785: "TDF+3TC+DTG2",
    23786: "ABC+3TC+DTG",
    23790: "TDF+3TC+LPV/r+RTV (2ª Linha)",
    23791: "TDF+3TC+ATV/r(2ª Linha)",
    23792: "ABC+3TC+ATV/r(2ª Linha)",
    23795: "ABC+3TC+ATV/r+RAL(2ª Linha Opt)",
    23796: "TDF+3TC+ATV/r+RAL(2ª Linha Opt)",
    23797: "ABC+3TC++RAL+DRV/r(3ª Linha)",
    23798: "3TC+RAL+DRV/r(3ª Linha)",
    23801: "AZT+3TC+RAL(2ª Linha)",
    23802: "AZT+3TC+DRV/r(2ª Linha)",
    23803: "AZT+3TC+RAL+DRV/r(3ª Linha)",
    23815: "AZT+3TC+DTG(2ª Linha)",
}

REFERRALS = {
    1044: "PEDIATRIA",
    1275: "CENTRO DE SAUDE",
    1386: "CLINICA MOVEL",
    1387: "LABORATÓRIO",
    1414: "PNCT",
    1595: "INTERNAMENTO",
    1596: "CONSULTA EXTERNA",
    1597: "ATS",
    1598: "PTV",
    1599: "PROVEDOR PRIVADO",
    1699: "CUIDADOS DOMICILIARIOS",
    1872: "CCR",
    1932: "PROFISSIONAL DE SAUDE",
    1984: "HR",
    1987: "SAAJ",
    2160: "VISITA DE BUSCA",
    5484: "APOIO NUTRICIONAL",
    6155: "MEDICO TRADICIONAL",
    6245: "ATSC",
    6288: "SMI",
    6303: "VGB",
    6304: "ATIP",
    6305: "OBC",
}

CARE_MODELS = {
    23724: "Gaac (GA)",
    23725: "ABORDAGEM FAMILIAR (AF)",
    23726: "CLUBES DE ADESÃO (CA)",
    23727: "PARAGEM ÚNICA (PU)",
    23729: "FLUXO RÁPIDO (FR)",
    23730: "DISPENSA TRIMESTRAL (DT)",
    23731: "DISPENSA COMUNITÁRIA (DC)",
    23888: "DISPENSA SEMESTRAL",
}
OTHER_MODEL = "OUTRO MODELO"
