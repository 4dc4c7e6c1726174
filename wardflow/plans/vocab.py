"""Recode vocabularies of the load jobs.

FIXED VALUES: the spellings and target terms below must equal the source
systems' cleaning rules for the loads to give the same results.  They are
stated as plain data, target -> spellings, in the order the rules list them;
``None`` as a target means "spelling becomes NULL".
"""

EMR_NAMES = {"OpenMRS": ["Open Medical Records System - OpenMRS"], "AMRS": ["Ampath AMRS"]}
EMR_AMRS_ONLY = {"AMRS": ["Ampath AMRS"]}
PROJECT_NAMES = {"Ampath Plus": ["Ampathplus", "AMPATH"],
                 "Kenya HMIS II": ["UCSF Clinical Kisumu", "CHAP Uzima", "DREAM", "IRDO"]}
PROJECT_NAMES_STATUS = {"Ampath Plus": ["Ampathplus"],
                        "Kenya HMIS II": ["UCSF Clinical Kisumu", "CHAP Uzima", "DREAM Kenya Trusts", "IRDO"]}
# In-text project map of the IPT / adverse-event scans.
PROJECT_IN_SCAN = {"Kenya HMIS II": ["I-TECH", "HMIS"]}

AE_SEVERITY = {
    "Mild": ["Mild", "Mild|Mild|Mild"],
    "Moderate": ["Moderate", "Moderate|Moderate", "Moderate|Moderate|Moderate"],
    "Severe": ["Severe", "Fatal", "Severe|Severe", "Severe|Severe|Severe"],
    "Unknown": ["Mild|Moderate", "Moderate|Mild", "Severe|Moderate", "Unknown|Moderate", "Moderate|Severe"],
    None: [""],
}
AE_ACTION = {
    "Drug not Changed": ["Medicine not changed", "CONTINUE REGIMEN", "CONTINUE REGIMEN|CONTINUE REGIMEN"],
    "Drug Reduced": ["Dose reduced"],
    "Drug Substituted": ["SUBSTITUTED DRUG"],
    "Drug Withdrawn": ["Medicine causing AE substituted/withdrawn", "STOP", "STOP|STOP", "All drugs stopped",
                       "STOP|STOP|STOP", "Other|STOP", "NONE|STOP"],
    "OTHER": ["Other", "NONE", "Select", "SUBSTITUTED DRUG|STOP", "Other|Other"],
    "Regimen Switched": ["SWITCHED REGIMEN"],
    None: [""],
}
AE_CAUSE = {
    "ARV": ["3TC/D4T", "3TC/TDF/NVP", "ABACAVIR", "abacavirwhen she was using", "ABC", "ABC+3TC", "abc/3tc/efv",
            "AF2B", "af2b- avonza", "ALL ARV", "ALUVIA", "art", "ARV", "arvs", "atanzanavir", "atavanavir",
            "ataz/rit", "atazanavir", "Atazanavir/Rironavir", "atazanavir/ritonavir", "ATV", "ATV/r", "ATVr", "AZT",
            "AZT+3TC+EFV", "AZT/3TC/NVP", "AZT/ATV", "AZT/KALETRA", "ctx/3tc/tdf/efv", "D4T", "D4T / 3TC / NVP",
            "D4T/3TC", "D4T/AZT", "DDI", "Dolotegravir", "doluteglavir", "dolutegravir", "DTG", "DTG Aurobindo",
            "dultegravir", "EFARIRENZ", "EFAVIRENCE", "Efavirens", "efavirenz", "efavirenze", "efavirez",
            "efervirence", "efervirenz", "efevurence", "EFV", "EFV 600MG", "EFV/NVP", "efv/rhze", "HAART",
            "KALETRA", "lopinanavir", "LOPINAVIR", "LPV", "LPV/r", "lpvr", "NVP", "NVP/ABC", "pep", "TDF",
            "tdf dtg", "TDF/3TC/", "tdf/3tc/dtg", "tdf/3tc/efv", "Tenoforvir", "tenofovir", "TLD", "TLE ",
            "TLE 400", "TRIMUNE", "ZIDOVUDINE", "EFV", "? NVP", "? TLD", "?ATV/r", "3TC", "3TC/3TC", "D4T",
            "EFAVIRENZ"],
    "ARV + OTHER DRUGS": ["ART/TB", "ARVS, CTX , IPT", "CTX OR EFV", "D4T/INH", "INH/NVP", "isoniazid and nevirapine",
                          "isoniazid efavirenz", "NVP/CTX", "tdf dtg ctx 3tc", "inh, tdf,3tc,dtg, ctx"],
    "NON-ARVS": ["ANT TB", "ANTI TB", "anti TBs", "ANTI-TB", "Co-trimoxazole", "CONTRIMAZOLE", "cotrimoxasole",
                 "cotrimoxazole", "cotrimoxazole 960mg", "Cotrimoxazole-", "CTX", "CTX /ANTI TB", "Dapson",
                 "fluconazole", "IHN", "INH", "INH (IPT)", "INH/CTX", "IPT", "ipt in 2016", "ipt side effect ", "IRIS",
                 "Isiniazid", "isiniazide", "isonaizid", "isoniaizid", "isoniasid", "isoniazid",
                 "Isoniazid - November 2017", "isoniazide", "isoniazin", "isonizid", "Isonizide and Pyridoxine",
                 "IZONIAZID", "IZONIAZIDE", "pyrazinamid", "pyrazinamide", "PYRIDOXINE", "RH", "RHE", "RHZE", "septin",
                 "SEPTRIN", "septrine", "Streptomycin", "sulfa", "sulphonamides", "SULPHONOMIDES", "SULPHUR", "TB",
                 "TB DRUGS", "tb meds", "2RHZ/4RH(children)", "2RHZE/10RH", "2RHZE/4RH", "2SRHZE/1RHZE/",
                 "INH, SEPTRIN"],
    None: [""],
}
AE_OUTCOME = {"Recovered": ["Recovered/Resolved"], "Recovering": ["Recovering/Resolving"],
              "OTHER": ["Requires intervention to prevent permanent damage"], None: [""]}

ALLERGY_SEVERITY = {"Fatal": ["Fatal"], "Mild": ["Mild|Mild|Mild", "Mild|Mild", "Mild"],
                    "Moderate": ["Moderate|Moderate", "Moderate"], "Severe": ["Severe"],
                    "Unknown": ["Unknown", "Moderate|Mild"]}

CONTACT_SEX = {"Undefined": ["U"], "Male": ["M"], "Female": ["F"]}
CONTACT_RELATION = {"Child": ["Daughter", "Son"], "Sexual Partner": ["Co-wife"], "OTHER": ["Select"],
                    "Undefined": ["undefined", "None"], "Niece": ["Nice"]}
IPV_OUTCOME = {"False": ["0", "No"], "True": ["Yes"], "OTHER": ["1065", "1066"]}
KNOWS_HIV_STATUS = {"Yes": ["Negative", "Yes", "Positive", "Exposed Infant", "Exposed", "664", "703"],
                    "No": ["No", "Unknown", "1067", "0"]}

VACCINATION_STATUS = {"Fully Vaccinated": ["Fully - Details not Available"],
                      "Partially Vaccinated": ["Partial", "Partial - Details not Available"]}

NEVER_OR_OTHER = {"Never": ["No"], "OTHER": ["Yes"]}

TB_SCREENING_IPT = {"Screened": ["1"], "Not Screened": ["TB Screening not done", "0"]}
IPT_INDICATION = {"Adherence Issues": ["Adherence Issues", "Poor adherence"],
                  "Client Traced back": ["Client Traced back a"],
                  "OTHER": ["No more drug Interru", "Toxicity Resolved", "Other patient decisi", "Pregnancy",
                            "Patient declined", "Other", "High CD4", "Education", "Client Discharged fr"]}

YES_NO_10 = {"Yes": ["Yes", "1"], "No": ["No", "0"]}
NO_YES_01 = {"No": ["0"], "Yes": ["1"]}

PREGNANT_VISIT = {"Yes": ["True", "LIVE BIRTH"],
                  "No": ["No - Miscarriage (mc)", "No - Induced Abortion (ab)", "RECENTLY MISCARRIAGED"],
                  None: ["UNKNOWN", ""]}
STABILITY = {"Stable": ["Stable1"], "Unstable": ["Not Stable"], None: [""]}
DIFFERENTIATED_CARE = {
    "Fast Track": ["Express Care", "Express", "Fast Track care", "Differentiated care model", "MmasRecommendation0"],
    "Community ART Distribution HCW Led": ["Community ART Distribution_Point",
                                           "Individual Patient ART Distribution_community",
                                           "Community Based Dispensing", "Community ART distribution - HCW led",
                                           "Community_Based_Dispensing"],
    "Community ART Distribution peer led": ["Community ART distribution � Peer led",
                                            "Community ART Distribution - Peer Led"],
    "Facility ART distribution Group": ["Facility ART Distribution Group", "FADG"],
    None: [""],
}

HTS_TESTED_AS = {"Couple": ["C: Couple (includes polygamous)", "Couple"], "Individual": ["I: Individual", "Individual"]}
HTS_TB_SCREENING = {"No Signs": ["No Signs", "No TB", "No TB signs", "Yes"],
                    "On TB Treatment": ["On TB Treatment", "INH", "TB Rx", "TBRx"],
                    "Presumed TB": ["Presumed TB", "PrTB"], "TB Confirmed": ["TB Confirmed"]}
HTS_SELF_TESTED = {"Yes": ["1", "Yes"], "No": ["0", "No"], "NA": ["NA"]}
HTS_DISCORDANT = {"Yes": ["Yes"], "No": ["No"]}
HTS_TEST_TYPE = {"Initial Test": ["Initial", "Initial Test"], "Repeat Test": ["Repeat", "Repeat Test"],
                 "Retest": ["Retest"]}
HTS_CONSENT = {"No": ["No"], "Yes": ["Yes"]}
HTS_SETTING = {"Facility": ["Facility", "Tent"], "Community": ["Community", "Medical Camp"]}
HTS_APPROACH = {"Client Initiated Testing (CITC)": ["CITC", "Client Initiated Testing (CITC)"],
                "Provider Initiated Testing(PITC)": ["PITC", "Provider Initiated Testing(PITC)"]}
GENDER_MF = {"Male": ["M"], "Female": ["F"]}
PATIENT_TYPE = {"Hospital Patient": ["HP:Hospital Patient"], "Non-Hospital Patient": ["NP:Non-Hospital Patient"]}
PNS_APPROACH = {"Provider Referral": ["Pr: Provider Referral", "D: Dual Referral"],
                "Passive Referral": ["Cr: Passive Referral"]}
LINKED_YN = {"Yes": ["Y"], "No": ["N"]}
PNS_CONSENT = {"No": ["0"]}

KEY_POPULATION = {"FSW": ["160579"], "MSM": ["160578"], "MSW": ["165084"], "PWID": ["105"]}
IN_SCHOOL_12 = {"Yes": ["1"], "No": ["2"]}
PREP_MARITAL = {"Married Monogamous": ["Married"], "Single": ["Never married"], "Cohabiting": ["Living with partner"],
                "Married Polygamous": ["Polygamous"], "Unknown": ["OTHER NON-CODED"], "Divorced": ["Separated"]}
PREP_COUNTY = {
    "Tharaka Nithi": ["THARAKA - NITHI", "Tharaka-Nithi"],
    "Siaya": ["North Alego", "West Sakwa", "Ugunja", "North Ugenya", "Ugenya West", "Ukwala", "West Alego"],
    "Homa Bay": ["Kabuoch South/Pala", "Gwassi North", "Homa Bay Arunjo", "HOMABAY", "Kendu Bay Town", "Kwabwai",
                 "Homa Bay East"],
    "Murang'a": ["Kamahuha", "Kambiti", "Nginda", "Muranga"],
    "Kiambu": ["KIAMBU''"],
    "Kisii": ["Majoge"],
    "Busia": ["Nangina"],
    "Nyandarua": ["Shamata"],
    "NOT DOCUMENTED": ["Kagen", "..."],
    None: [""],
}
