"""Declared schemas of the register's payloads and rules to conform to them."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Field names, types and order of the payloads, as Spark DDL.
# Whole numbers are bigint, amounts are double, dates arrive as text.
_DISCOUNT = ("discountId bigint, discountName string, discountReason string, amount double, "
             "transactionItemId bigint")
_ORDER_TAX = "rateName string, amount double"
_LINE_TAX = "rateName string, rate double, amount double, transactionItemId bigint"
_LAB_RESULT = "labTest string, value double, labResultUnit string"
_ROOM = "roomId bigint, room string, quantityAvailable double"
_ITEM = (
    "transactionId bigint, productId bigint, totalPrice double, quantity double, "
    "unitPrice double, unitCost double, packageId string, sourcePackageId string, "
    "totalDiscount double, unitId bigint, unitWeight double, unitWeightUnit string, "
    "flowerEquivalent double, flowerEquivalentUnit string, "
    f"discounts array<struct<{_DISCOUNT}>>, taxes array<struct<{_LINE_TAX}>>, "
    "returnDate string, isReturned boolean, returnedByTransactionId bigint, "
    "returnReason string, batchName string, transactionItemId bigint, vendor string, "
    "isCoupon boolean")
_INVENTORY_HEAD = (
    "productId bigint, sku string, productName string, description string, categoryId bigint, "
    "category string, imageUrl string, quantityAvailable double, quantityUnits string, "
    "unitWeight double, flowerEquivalent double, recFlowerEquivalent double, "
    "flowerEquivalentUnits string, batchId bigint, batchName string, packageId string, "
    "packageStatus string, unitPrice double, medUnitPrice double, recUnitPrice double, "
    "strainId bigint, strain string, strainType string, size string, "
    f"labResults array<struct<{_LAB_RESULT}>>, testedDate string, sampleDate string, "
    "packagedDate string, manufacturingDate string, lastModifiedDateUtc string, "
    "labTestStatus string, vendorId bigint, vendor string, expirationDate string, "
    f"roomQuantities array<struct<{_ROOM}>>, pricingTierName string, alternateName string, "
    "tags array<string>, brandId bigint, brandName string, medicalOnly boolean, "
    "externalPackageId string, producer string, producerId bigint, lineage array<string>, "
    "potencyIndicator string, masterCategory string, effectivePotencyMg double, "
    "isCannabis boolean, packageNDC string")
_DDL = {
    "Customer": (
        "customerId bigint, name string, firstName string, lastName string, middleName string, "
        "nameSuffix string, namePrefix string, address1 string, address2 string, city string, "
        "state string, postalCode string, phone string, cellPhone string, emailAddress string, "
        "status string, mmjidNumber string, mmjidExpirationDate string, "
        "lastModifiedDateUTC string, creationDate string, customerType string, gender string, "
        "driversLicenseHash string, dateOfBirth string, externalCustomerId string, "
        "createdByIntegrator string, isAnonymous boolean, referralSource string, "
        "otherReferralSource string, springBigMemberId bigint, customIdentifier string, "
        "discountGroups array<string>, createdAtLocation string, notes string, "
        "isLoyaltyMember boolean, primaryQualifyingCondition string, "
        "secondaryQualifyingConditions array<string>, mergedIntoCustomerId bigint"),
    "Employee": (
        "userId bigint, loginId string, fullName string, defaultLocation string, status string, "
        "stateId string, mmjExpiration string, permissionsLocation string, groups string"),
    "LoyaltySnapshot": (
        "customerId bigint, loyaltyBalance double, loyaltySpent double, loyaltyEarned double"),
    "Transaction": (
        "transactionId bigint, customerId bigint, employeeId bigint, transactionDate string, "
        "voidDate string, isVoid boolean, subtotal double, totalDiscount double, "
        "totalBeforeTax double, tax double, tipAmount double, total double, paid double, "
        "changeDue double, totalItems bigint, terminalName string, checkInDate string, "
        "invoiceNumber string, isTaxInclusive boolean, transactionType string, "
        f"loyaltyEarned double, loyaltySpent double, items array<struct<{_ITEM}>>, "
        f"discounts array<struct<{_DISCOUNT}>>, lastModifiedDateUTC string, cashPaid double, "
        "debitPaid double, electronicPaid double, electronicPaymentMethod string, "
        "checkPaid double, creditPaid double, giftPaid double, mmapPaid double, "
        "prePaymentAmount double, revenueFeesAndDonations double, "
        "nonRevenueFeesAndDonations double, feesAndDonations array<string>, "
        f"taxSummary array<struct<{_ORDER_TAX}>>, returnOnTransactionId bigint, "
        "adjustmentForTransactionId bigint, orderType string, wasPreOrdered boolean, "
        "orderSource string, orderMethod string, invoiceName string, isReturn boolean, "
        "authCode string, customerTypeId bigint, isMedical boolean, orderIds array<bigint>, "
        "totalCredit double, completedByUser string, responsibleForSaleUserId bigint, "
        "transactionDateLocalTime string, estTimeArrivalLocal string, "
        "estDeliveryDateLocal string"),
    "AppliedDiscount": _DISCOUNT,
    "TaxSummaryInfo": _ORDER_TAX,
    "TransactionItem": _ITEM,
    "LineItemTaxInfo": _LINE_TAX,
    "ProductDetail": (
        "productId bigint, sku string, internalName string, masterCategory string, "
        "categoryId bigint, category string, imageUrl string, imageUrls array<string>, "
        "strainId bigint, strain string, strainType string, size string, netWeight double, "
        "netWeightUnitId bigint, netWeightUnit string, brandId bigint, brandName string, "
        "vendorId bigint, vendorName string, isCannabis boolean, isActive boolean, "
        "isCoupon boolean, thcContent double, thcContentUnit string, cbdContent double, "
        "cbdContentUnit string, productGrams double, flowerEquivalent double, "
        "recFlowerEquivalent double, price double, medPrice double, recPrice double, "
        "unitCost double, unitType string, onlineTitle string, onlineDescription string, "
        "onlineProduct boolean, posProducts boolean, pricingTier bigint, "
        "onlineAvailable boolean, lowInventoryThreshold double, pricingTierName string, "
        "pricingTierDescription string, "
        "pricingTierData array<struct<startWeight double, endWeight double, price double>>, "
        "flavor string, alternateName string, lineageName string, distillationName string, "
        "maxPurchaseablePerTransaction double, tags array<string>, dosage string, "
        "instructions string, allergens string, defaultUnit string, producerId bigint, "
        "producerName string, createdDate string, isMedicalOnly boolean, "
        "lastModifiedDateUTC string, grossWeight double, isTaxable boolean, "
        "taxCategories array<string>, upc string, regulatoryCategory string, ndc string, "
        "daysSupply double, illinoisTaxCategory string, externalCategory string, "
        "syncExternally boolean, regulatoryName string, administrationMethod string, "
        "unitCBDContentDose double, unitTHCContentDose double, oilVolume double, "
        "ingredientList string, expirationDays bigint, abbreviation string, "
        "isTestProduct boolean, isFinished boolean, allowAutomaticDiscounts boolean, "
        "servingSize string, servingSizePerUnit bigint, isNutrient boolean, productName string, "
        "description string"),
    "ProductCategory": (
        "productCategoryId bigint, productCategoryName string, masterCategory string"),
    "Brand": "brandId bigint, brandName string",
    "ReportingInventoryItem": (
        "unitWeightUnit string, unitCost double, allocatedQuantity double, " + _INVENTORY_HEAD),
    "InventoryItem": "unitWeightUnit string, " + _INVENTORY_HEAD,
    "InventorySnapshot": (
        "sku string, product string, productId bigint, room string, roomId bigint, "
        "vendor string, packageId string, batchName string, batchId bigint, quantity double, "
        "totalCost double, unit string, unitId bigint, status string, snapshotDate string"),
    "LabResult": _LAB_RESULT,
    "InventoryRoomQuantity": _ROOM,
}

SCHEMA_NAMES = list(_DDL)
LOCATION = ["org", "store"]


def pos_schema(name: str) -> T.StructType:
    """Declared schema of a payload, without the location columns."""
    if name not in _DDL:
        raise KeyError(f"schema {name!r} not found, have {SCHEMA_NAMES}")
    return T.StructType.fromDDL(_DDL[name])


def expected_columns(name: str, include: list[str] = [], ignore: list[str] = []) -> list[str]:
    wanted = [*pos_schema(name).names, *LOCATION, *include]
    return [c for c in dict.fromkeys(wanted) if c not in ignore]


class SchemaMismatch(ValueError):
    """A declared column is missing from the data."""


def conform_schema(df: DataFrame, name: str, include: list[str] = [],
                   ignore: list[str] = []) -> DataFrame:
    """Declared columns in declared order; extra columns are dropped with a warning.

    A missing column is an error. The location columns are always expected.
    """
    wanted = expected_columns(name, include, ignore)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"{name}: columns not found: {', '.join(missing)}")
    extra = [c for c in df.columns if c not in wanted]
    if extra:
        log.warning("%s: dropping undefined columns: %s", name, ", ".join(extra))
    return df.select(*wanted)


def location_problems(df: DataFrame) -> DataFrame:
    """One row: number of rows and of rows without org or store.

    A usable table has rows and no problem rows; a missing column is an error
    at once.
    """
    missing = [c for c in LOCATION if c not in df.columns]
    if missing:
        raise SchemaMismatch(f"data is missing expected columns: {', '.join(missing)}")
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(F.col("org").isNull() | F.col("store").isNull())
                  .alias("rows_without_location"))


def add_location_ids(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Add ``org_uuid`` and ``store_uuid``; an unknown location keeps NULL ids."""
    ids = locations.select(*LOCATION, "org_uuid", "store_uuid")
    return df.drop("org_uuid", "store_uuid").join(ids, LOCATION, "left")
