"""Declared schemas. Every column is nullable."""

from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StringType, StructField, StructType

TYPES = {"string": StringType(), "int": IntegerType(), "float": FloatType()}


def typed(columns):
    """A schema from names and their types, or from ``name type, ...``; needs no running session."""
    if isinstance(columns, str):
        columns = dict(c.split() for c in columns.split(","))
    return StructType([StructField(name, TYPES[t], True) for name, t in columns.items()])


def all_text(names):
    """Land everything as text; typing is a later step."""
    return StructType([StructField(n, StringType(), True) for n in names])


def differences(df, declared, required=()):
    """(column, declared, actual, nulls, status) for every column of a table or its declared schema.

    ``status`` is ``missing``, ``extra``, ``type``, ``null`` (a required column with NULLs) or ``same``,
    the first that holds. Types and names are read off the schemas; NULLs are counted in one pass over
    the required columns alone.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in declared}
    present = [c for c in required if c in actual]
    counts = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(present)]
    totals = df.agg(F.count(F.lit(1)).alias("total"), *counts)
    cells = []
    for c in [*wanted, *[c for c in actual if c not in wanted]]:
        nulls = F.col(f"nulls_{present.index(c)}") if c in present else F.lit(None).cast("bigint")
        status = F.lit("missing" if c not in actual else "extra" if c not in wanted else
                       "type" if actual[c] != wanted[c] else "same")
        if c in present and c in wanted and actual[c] == wanted[c]:
            status = F.when(nulls > 0, "null").otherwise("same")
        cells.append(F.struct(
            F.lit(c).alias("column"), F.lit(wanted.get(c)).cast("string").alias("declared"),
            F.lit(actual.get(c)).cast("string").alias("actual"), nulls.alias("nulls"),
            status.alias("status")))
    return totals.select(F.inline(F.array(*cells)))


def conform(df, declared):
    """The declared columns, in their order and with their types, as ``DataFrame.to`` gives them.

    Columns that are not declared are dropped, missing ones that may be NULL are NULL, and a value is
    only widened: a type that would lose values (a text as a number) raises an error.
    """
    return df.to(declared)


def as_text(schema):
    """The raw-text twin of a typed schema."""
    return all_text(schema.fieldNames())


# Column names and types of the input files.
AIRPORTS = typed({
    "faa": "string", "name": "string", "lat": "float", "lon": "float", "alt": "int",
    "tz": "float", "dst": "string",
})
AIRPORTS_WHOLE_HOURS = typed({
    "faa": "string", "name": "string", "lat": "float", "lon": "float", "alt": "int",
    "tz": "int", "dst": "string",
})
PLANES = typed({
    "tailnum": "string", "year": "int", "type": "string", "manufacturer": "string",
    "model": "string", "engines": "int", "seats": "int", "speed": "int", "engine": "string",
})
FLIGHTS = typed({
    "year": "int", "month": "int", "day": "int", "dep_time": "int", "dep_delay": "int",
    "arr_time": "int", "arr_delay": "int", "carrier": "string", "tailnum": "string",
    "flight": "int", "origin": "string", "destiny": "string", "air_time": "int",
    "distance": "int", "hour": "int", "minute": "int",
})
FLIGHTS_TEXT_TIMES = typed({
    "year": "int", "month": "int", "day": "int", "dep_time": "string", "dep_delay": "int",
    "arr_time": "string", "arr_delay": "int", "carrier": "string", "tailnum": "string",
    "flight": "string", "origin": "string", "dest": "string", "air_time": "int",
    "distance": "int", "hour": "int", "minute": "int",
})
CENSUS = typed({
    "age": "int", "workclass": "string", "fnlwgt": "float", "education": "string",
    "education-num": "int", "marital-status": "string", "occupation": "string",
    "relationship": "string", "race": "string", "sex": "string", "capital-gain": "float",
    "capital-loss": "float", "hours-per-week": "float", "native-country": "string",
    "income": "string",
})
RETAIL = all_text([
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
    "CustomerID", "Country",
])
COMMUNITIES = all_text([
    "state", "county", "community", "communityname", "fold", "population", "householdsize",
    "racepctblack", "racePctWhite", "racePctAsian", "racePctHisp", "agePct12t21",
    "agePct12t29", "agePct16t24", "agePct65up", "numbUrban", "pctUrban", "medIncome",
    "pctWWage", "pctWFarmSelf", "pctWInvInc", "pctWSocSec", "pctWPubAsst", "pctWRetire",
    "medFamInc", "perCapInc", "whitePerCap", "blackPerCap", "indianPerCap", "AsianPerCap",
    "OtherPerCap", "HispPerCap", "NumUnderPov", "PctPopUnderPov", "PctLess9thGrade",
    "PctNotHSGrad", "PctBSorMore", "PctUnemployed", "PctEmploy", "PctEmplManu",
    "PctEmplProfServ", "PctOccupManu", "PctOccupMgmtProf", "MalePctDivorce", "MalePctNevMarr",
    "FemalePctDiv", "TotalPctDiv", "PersPerFam", "PctFam2Par", "PctKids2Par",
    "PctYoungKids2Par", "PctTeen2Par", "PctWorkMomYoungKids", "PctWorkMom", "NumIlleg",
    "PctIlleg", "NumImmig", "PctImmigRecent", "PctImmigRec5", "PctImmigRec8", "PctImmigRec10",
    "PctRecentImmig", "PctRecImmig5", "PctRecImmig8", "PctRecImmig10", "PctSpeakEnglOnly",
    "PctNotSpeakEnglWell", "PctLargHouseFam", "PctLargHouseOccup", "PersPerOccupHous",
    "PersPerOwnOccHous", "PersPerRentOccHous", "PctPersOwnOccup", "PctPersDenseHous",
    "PctHousLess3BR", "MedNumBR", "HousVacant", "PctHousOccup", "PctHousOwnOcc",
    "PctVacantBoarded", "PctVacMore6Mos", "MedYrHousBuilt", "PctHousNoPhone",
    "PctWOFullPlumb", "OwnOccLowQuart", "OwnOccMedVal", "OwnOccHiQuart", "RentLowQ",
    "RentMedian", "RentHighQ", "MedRent", "MedRentPctHousInc", "MedOwnCostPctInc",
    "MedOwnCostPctIncNoMtg", "NumInShelters", "NumStreet", "PctForeignBorn",
    "PctBornSameState", "PctSameHouse85", "PctSameCity85", "PctSameState85", "LemasSwornFT",
    "LemasSwFTPerPop", "LemasSwFTFieldOps", "LemasSwFTFieldPerPop", "LemasTotalReq",
    "LemasTotReqPerPop", "PolicReqPerOffic", "PolicPerPop", "RacialMatchCommPol",
    "PctPolicWhite", "PctPolicBlack", "PctPolicHisp", "PctPolicAsian", "PctPolicMinor",
    "OfficAssgnDrugUnits", "NumKindsDrugsSeiz", "PolicAveOTWorked", "LandArea", "PopDens",
    "PctUsePubTrans", "PolicCars", "PolicOperBudg", "LemasPctPolicOnPatr",
    "LemasGangUnitDeploy", "LemasPctOfficDrugUn", "PolicBudgPerPop", "ViolentCrimesPerPop",
])
