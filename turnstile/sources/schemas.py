"""Schemas of the ticketing source tables, as used by the staging jobs.

Column names are lower case (Spark resolves names case-insensitively, so the
mixed-case spellings of the operational database also work).  Codes and ids
are ``bigint``; money is ``decimal(19,4)``; dates are ``timestamp_ntz``.
"""

SOURCE_SCHEMAS: dict[str, str] = {
    "tickets": "ticode bigint, tipricetype bigint, tifullprice decimal(19,4), "
               "timailinglist bigint, titransactnum bigint, tistatus int, "
               "tievent bigint, tishift bigint, tiorder bigint",
    "events": "evcode bigint, evshow bigint, eveventdate timestamp_ntz, evpricelist bigint",
    "shows": "shcode bigint, shdescr string, shlongminutes int",
    "shifts": "sfcode bigint, sfactiontype int, sftill bigint, sfactiondate timestamp_ntz",
    "till": "tilcode bigint, tildescr string",
    "clients": "cltcode bigint, cltfirstname string, cltsurname string, cltemail string",
    "recieptbase": "rcbcode bigint, rcbtransactnum bigint, rcbpaytype bigint, "
                   "rcbshiftdate timestamp_ntz, rcbcachinout int, rcbpayamount decimal(19,4)",
    "paytype": "ptcode bigint, ptdescr string",
    "recieptcredit": "rcccode bigint, rcccreditnum string, rccparamsdata string",
    "calculatedcommission": "clcticketnum bigint, clcsum decimal(19,4)",
    "get_orderguides": "gogordernumber bigint, gogticketid bigint, gogguidenumber bigint",
    "pricetype": "pctcode bigint, pctdescr string",
    "pricediscount": "pdpricetype bigint, pdpricelist bigint, pdcalculatedprice decimal(19,4)",
    "pricelist": "prlcode bigint",
    "crm_users": "id string, user_name string, first_name string, last_name string",
    "crossref": "sugarid string, sugarmodule string, pecode bigint",
    "guiders": "gdrcode bigint, gdrcontactnoinreltable bigint",
    "ordercontacts": "orcrecordid bigint, orcordernumber bigint, orcfullname string",
    "clientaddresses": "claclientcode bigint, claisformailing int, claaddresscode bigint",
    "addresses": "adrcode bigint, adraddress1 string, adraddress2 string, adrcitydesc string, "
                 "adrstatedesc string, adrzipcode string, adrcountrydesc string",
    "clientphonenumbers": "cpnclientcode bigint, cpnphonenumber string",
}

ADDRESS_COLUMNS = ["adraddress1", "adraddress2", "adrcitydesc", "adrstatedesc",
                   "adrzipcode", "adrcountrydesc"]
