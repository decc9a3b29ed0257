"""Closed vocabularies and normalisation dictionaries (fixed values; the order is part of them)."""

from __future__ import annotations

GARMENTS = ["kurta_set", "kurta_dress", "co_ord", "anarkali", "straight_kurta", "a_line_kurta", "tunic", "ethnic_dress", "casual_saree", "fusion_top", "ethnic_shirt"]
FABRICS = ["cotton", "cotton_blend", "linen", "linen_blend", "rayon", "modal", "chanderi", "georgette", "crepe", "chiffon", "khadi", "polyester_blend", "jacquard", "silk", "organza", "satin", "net", "velvet"]
TECHNIQUES = ["solid", "self_texture", "chikankari", "block_print", "floral_print", "geometric_print", "ethnic_motif", "digital_print", "thread_embroidery", "mirror_work", "schiffli", "pintuck", "lace_cutwork", "gota_patti", "sequin_work", "ikat", "brocade", "beadwork", "bandhani", "zari_zardosi", "kalamkari"]
SILHOUETTES = ["straight", "a_line", "flared", "anarkali", "fit_and_flare", "tiered", "high_low", "boxy", "kaftan", "shirt_style", "angrakha", "empire"]
COLOR_FAMILIES = ["pastel", "earth", "neutral", "white_on_white", "jewel", "bright", "dual_tone", "multicolor"]

GARMENT_WORDS = {
    "kurta": "straight_kurta", "kurti": "straight_kurta", "straight_kurta": "straight_kurta", "a_line_kurta": "a_line_kurta",
    "kurta_set": "kurta_set", "kameez": "kurta_set", "kurta_dress": "kurta_dress", "co_ord": "co_ord", "coord": "co_ord",
    "anarkali": "anarkali", "tunic": "tunic", "saree": "casual_saree", "casual_saree": "casual_saree", "choli": "casual_saree",
    "blouse": "casual_saree", "ethnic_dress": "ethnic_dress", "dress": "ethnic_dress", "kaftan": "ethnic_dress",
    "lehenga": "ethnic_dress", "jumpsuit": "ethnic_dress", "ethnic_shirt": "ethnic_shirt", "sherwani": "ethnic_shirt", "fusion_top": "fusion_top",
}
FABRIC_WORDS = {f: f for f in FABRICS}
TECHNIQUE_WORDS = {t: t for t in TECHNIQUES} | {
    "plain": "solid", "woven": "self_texture", "weaving": "self_texture", "print": "digital_print", "printed": "digital_print",
    "embroidery": "thread_embroidery", "lace": "lace_cutwork", "cutwork": "lace_cutwork", "gotapatti": "gota_patti",
    "sequin": "sequin_work", "sequins": "sequin_work", "zari": "zari_zardosi", "zardosi": "zari_zardosi", "zardozi": "zari_zardosi",
}
STYLING_LOWER = {
    "palazzo": "with_palazzo", "churidar": "with_churidar", "salwar": "with_churidar", "pants": "with_pants",
    "trousers": "with_pants", "pyjama": "with_pants", "jeans": "with_jeans", "denim": "with_jeans",
}
STYLING_OUTER = {
    "dupatta": "with_dupatta", "shawl": "with_dupatta", "stole": "with_dupatta", "jacket": "with_jacket",
    "cardigan": "with_jacket", "nehru": "with_jacket", "shrug": "with_jacket",
}
EMBELLISHMENT = {
    "solid": "everyday", "self_texture": "everyday", "floral_print": "everyday", "geometric_print": "everyday", "digital_print": "everyday",
    "pintuck": "everyday", "chikankari": "everyday", "block_print": "everyday", "lace_cutwork": "everyday",
    "mirror_work": "festive_lite", "thread_embroidery": "festive_lite", "gota_patti": "festive_lite", "ethnic_motif": "festive_lite",
}
HAUL_TAGS = [
    "myntrahaul", "ajiohaul", "kurtahaul", "ethnichaul", "myntrafinds", "myntrahauls", "meeshohaul", "amazonkurtihaul",
    "kurtasethaul", "haul", "meeshofinds", "amazonfinds", "flipkartfinds", "budgetfinds", "whatiorderedvswhatigot",
    "amazonhaul", "tryonhaul", "ethnicwearhaul", "haulvideo", "festivehaul", "earringhaul",
]

#: Garment by tag and by keyword, in order of declaration.
GARMENT_TAGS = {
    "kurta_set": ["kurtaset", "kurtasets", "kurtiset", "kurtapalazzoset", "kurtasetsonline", "kurtastyle", "salwarkameez", "salwarsuit", "suits", "suit", "punjabisuit", "partywearsuits", "partywearsuit", "designersuits", "designersuit", "cottonsuits", "cottonsuit", "weddingsuits"],
    "anarkali": ["anarkali", "anarkalisuit", "anarkalikurta", "anarkalidress"],
    "co_ord": ["coordset", "coordsets", "twinningset", "matchingset"],
    "kurta_dress": ["kurtadress", "ethnicdress", "indiandress"],
    "casual_saree": ["saree", "sareelove", "readytowearsaree", "casualsaree", "officesaree", "sareeindia", "sareesofinstagram", "sareeswag", "sari"],
    "straight_kurta": ["straightkurta", "straightkurti", "straightcut"],
    "tunic": ["kurti", "tunic", "ethnictunic", "shortkurti", "longkurti", "kurties"],
    "fusion_top": ["fusiontop", "croptop", "peplumtop", "fusionwear", "peplumkurta"],
    "ethnic_shirt": ["ethnicshirt", "indianshirt", "bandcollarshirt"],
    "a_line_kurta": ["alinekurta", "alinekurti"],
    "ethnic_dress": ["indowesterndress"],
}
GARMENT_KEYWORDS = {
    "kurta_set": ["kurta set", "kurta palazzo set", "kurta pant set", "3 piece set", "salwar kameez", "salwar suit", "punjabi suit"],
    "anarkali": ["anarkali"],
    "co_ord": ["co-ord", "coord set", "matching set"],
    "kurta_dress": ["kurta dress", "ethnic dress"],
    "casual_saree": ["saree", "sari", "ready to wear saree"],
    "straight_kurta": ["straight kurta", "straight cut"],
    "tunic": ["kurti", "tunic"],
    "fusion_top": ["fusion top", "peplum", "crop top"],
    "ethnic_shirt": ["ethnic shirt", "band collar"],
    "a_line_kurta": ["a-line kurta", "a line kurta"],
    "ethnic_dress": ["indo western dress", "tiered dress", "shirt dress ethnic"],
}
FABRIC_TAGS = {
    "cotton": ["cotton", "cottonkurta", "cottonsuit", "purecotton", "mulmul", "cambric", "cottonkurtaset", "summercotton", "mulmulkurta"],
    "linen": ["linen", "linenkurta", "linenkurti", "purelinen", "linenblend", "linencotton"],
    "rayon": ["rayon", "viscose", "rayonkurta"],
    "modal": ["modal", "modalsatin", "modalcotton"],
    "chanderi": ["chanderi", "chanderikurta", "chandericotton"],
    "georgette": ["georgette", "georgettekurta"],
    "khadi": ["khadi", "khadicotton", "handspun", "khadikurta"],
}
FABRIC_KEYWORDS = {"cotton": ["cotton", "mulmul", "muslin", "cambric"], "linen": ["linen"], "rayon": ["rayon", "viscose"], "modal": ["modal"], "chanderi": ["chanderi"], "georgette": ["georgette"], "khadi": ["khadi", "handspun"]}
TECHNIQUE_TAGS = {
    "chikankari": ["chikankari", "chikan", "chikanwork", "lucknowi", "lucknowichikankari", "chikankarisuit", "chikankarikurta", "chikankaricollection", "chickenkurta"],
    "block_print": ["blockprint", "handblockprint", "jaipuriprint", "ajrakh", "bagru", "handblock", "blockprintkurta"],
    "solid": ["solid", "solidkurta", "plain", "minimal"],
    "floral_print": ["floralprint", "floralkurta", "floralsuit", "ditsy", "botanical"],
    "geometric_print": ["stripes", "checks", "ikat", "geometric", "chevron", "abstract"],
    "ethnic_motif": ["paisley", "kalamkari", "bandhani", "bandhej", "buta"],
    "thread_embroidery": ["embroidery", "threadwork", "threadembroidery", "embroidered"],
    "mirror_work": ["mirrorwork", "shisha", "mirrorembroidery"],
    "self_texture": ["selfdesign", "selftexture", "selfstripe", "dobby", "jacquard"],
    "digital_print": ["digitalprint", "digitalprintkurta"],
    "pintuck": ["pintuck", "pintuckkurta"],
    "lace_cutwork": ["lace", "cutwork", "crochet", "schiffli"],
    "gota_patti": ["gotapatti", "gota", "gotawork"],
}
TECHNIQUE_KEYWORDS = {
    "chikankari": ["chikankari", "chikan", "lucknowi"],
    "block_print": ["block print", "hand block", "ajrakh", "bagru", "jaipur print"],
    "solid": ["solid", "plain"],
    "floral_print": ["floral", "ditsy", "botanical"],
    "geometric_print": ["stripe", "check", "ikat", "geometric"],
    "ethnic_motif": ["paisley", "kalamkari", "bandhani", "bandhej"],
    "thread_embroidery": ["embroidery", "thread work", "embroidered"],
    "mirror_work": ["mirror work", "shisha"],
    "self_texture": ["self design", "self texture", "jacquard", "dobby"],
    "digital_print": ["digital print"],
    "pintuck": ["pintuck"],
    "lace_cutwork": ["lace", "cutwork", "schiffli"],
    "gota_patti": ["gota patti", "gota work"],
}
OCCASION_TAGS = {
    "office": ["officewear", "officekurta", "workwear", "workwearethnic", "indianofficewear", "officelook", "corporateethnic", "indowesternoffice", "officestyle", "worklook", "workoutfit", "businesscasual"],
    "casual": ["casualethnic", "everydayethnic", "dailywear", "casualwear", "casuallook", "indowestern", "casualootd", "relaxedlook", "homewear", "lounge"],
    "campus": ["collegewear", "campuslook", "collegefashion", "studentfashion", "collegegirl", "campusstyle"],
    "weekend": ["weekendlook", "brunch", "weekendoutfit", "sundaylook", "partywear", "partyoutfit", "eveningwear", "nightout", "datenight", "sundowner", "cocktailparty"],
    "festive_lite": ["festivevibes", "pujalook", "festivelook", "akshayatritiya", "indianwedding", "wedding", "weddingguest", "weddingseason", "lehengacholi", "indianweddingdress", "designerlehenga", "bridalwear", "bridallook", "mehendi", "mehendicerumony", "sangeet", "haldi", "reception", "engagement", "navratri", "diwali", "eid", "durgapuja", "ganeshchaturthi", "festivewear", "functionwear", "familyfunction", "weddingfashion", "weddingcollection", "weddingedit", "weddinginspiration"],
    "travel": ["travelootd", "travelstyle", "travelwear", "vacationoutfit", "holidaylook", "traveldiaries", "tripoutfit"],
}
OCCASION_KEYWORDS = {
    "office": ["office", "workwear", "work wear", "corporate", "desk to dinner", "professional", "9 to 5", "business casual"],
    "casual": ["casual", "everyday", "daily wear", "easy wear", "indo western"],
    "campus": ["college", "campus", "university", "student"],
    "weekend": ["weekend", "brunch", "outing", "day out", "party", "evening wear", "date night"],
    "festive_lite": ["festive", "puja", "small function", "get together", "akshaya tritiya", "wedding", "mehendi", "sangeet", "haldi", "reception", "engagement", "navratri", "diwali", "eid", "festival", "function"],
    "travel": ["travel", "trip", "vacation", "holiday", "sightseeing"],
}
STYLING_TAGS = {
    "with_palazzo": ["palazzo", "palazzoset", "kurtapalazzo"],
    "with_pants": ["kurtapants", "cigarettepants", "straightpants", "trousers"],
    "with_churidar": ["churidar", "churidarset"],
    "with_dupatta": ["dupatta", "3pieceset", "suitset"],
    "standalone": ["kurtadress", "ethnicdress", "onepieceethnic", "maxidress"],
    "with_jacket": ["jacket", "shrug", "overlay", "layered"],
    "with_jeans": ["kurtawithjeans", "ethnicwithjeans", "fusionlook"],
}
STYLING_KEYWORDS = {
    "with_palazzo": ["palazzo"],
    "with_pants": ["pants", "cigarette pants", "straight pants", "trousers"],
    "with_churidar": ["churidar"],
    "with_dupatta": ["dupatta", "3 piece", "suit set"],
    "standalone": ["dress", "one piece", "standalone"],
    "with_jacket": ["jacket", "shrug", "overlay"],
    "with_jeans": ["with jeans", "denim"],
}
ATTRIBUTES = {
    "garment": (GARMENT_TAGS, GARMENT_KEYWORDS),
    "fabric": (FABRIC_TAGS, FABRIC_KEYWORDS),
    "technique": (TECHNIQUE_TAGS, TECHNIQUE_KEYWORDS),
    "occasion": (OCCASION_TAGS, OCCASION_KEYWORDS),
    "styling": (STYLING_TAGS, STYLING_KEYWORDS),
}
GENERIC_KNOWN = ["kurta", "lehenga", "choli", "salwar", "dhoti", "saree", "ethnic_motif", "ethnicwear", "indianwear", "indianfashion", "indianoutfits", "traditionallook"]
STYLINGS = ["with_palazzo", "with_pants", "with_churidar", "with_dupatta", "standalone", "with_jacket", "with_jeans", "co_ord_set"]
OCCASIONS = ["office", "casual", "campus", "weekend", "festive_lite", "travel"]
META_EXACT = [
    "love", "instagood", "viral", "trending", "instadaily", "photooftheday", "picoftheday", "aesthetic", "vibes", "lifestyle",
    "follow", "like", "explore", "explorepage", "foryou", "foryoupage", "fyp",
    "supportsmallbusiness", "smallbusiness", "handmade", "shopnow", "shoplocal", "supportlocal",
    "designer", "designers", "fashion", "fashionblogger", "fashionista", "fashiongram", "fashionstyle", "ootd", "style", "stylish",
    "styleblogger", "styleinspo", "trends", "luxurywear", "luxury", "traditional", "indiantraditionalwear",
    "menswear", "mensethnicwear", "menfashion", "mensfashion", "india", "indian", "mumbai", "delhi", "bangalore", "bollywood",
    "desiaesthetic", "desilook", "desistyle", "desivibes", "desigirl", "desiwear", "desifashion", "desibride", "desigram",
    "sareenotsorry", "sareelover", "sareeobsession",
]
META_PREFIXES = ["reels", "reel"]


def tag_index(table: dict[str, list[str]]) -> dict[str, str]:
    """Value by tag; of a tag declared twice the later value holds."""
    return {tag: value for value, tags in table.items() for tag in tags}


def known_tags() -> list[str]:
    tags: dict[str, None] = {}
    for table, _ in ATTRIBUTES.values():
        tags |= dict.fromkeys(tag_index(table))
    for values in (GARMENTS, FABRICS, TECHNIQUES, OCCASIONS, STYLINGS, SILHOUETTES, GENERIC_KNOWN):
        tags |= dict.fromkeys(values)
    return list(tags)
