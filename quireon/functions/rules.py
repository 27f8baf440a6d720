"""Vocabularies, spellings and labels that results depend on."""

# State codes of an image, and what a code decides.
STATES = {"f": "en français", "a": "en allemand", "l": "en latin", "t": "en italien", "v": "structure vide", "p": "pas la peine", "m": "manuscrit", "b": "sans texte", "d": "Doublon", "x": "n'existe plus", "r": "à renommer dans Z:", "s": "spécial"}
LANGUAGE_STATES = ["f", "a", "l", "t"]
YES_STATES = ["f", "a", "l", "t", "m", "b", "r"]

# OCR corrections: confused characters, in order, then words (long s), each a whole word.
LETTER_RULES = [
    (r"l(\d+)", r"1\1"), (r"(\d+)l", r"\g<1>1"), (r"(\d+)l(\d+)", r"\g<1>1\2"),
    (r"I(\d+)", r"1\1"), (r"(\d+)I", r"\g<1>1"), (r"(\d+)I(\d+)", r"\g<1>1\2"),
    (r"([a-z]+)1([a-z]*)", r"\1l\2"), (r"([A-Z])1([a-z]+)", r"\1l\2"),
    (r"([A-Z]+)1([A-Z]*)", r"\1I\2"),
    (r"([A-Z]*)l([A-Z]+)", r"\1I\2"), (r"([A-Z][A-Z]+)l([A-Z]*)", r"\1I\2"),
    (r"([a-z]+)I([a-z]*)", r"\1l\2"),
    (r"(\d+)o", r"\g<1>0"), (r"(\d+)o(\d+)", r"\g<1>0\2"), (r"(\d+)O", r"\g<1>0"), (r"(\d+)O(\d+)", r"\g<1>0\2"),
    (r"([A-Za-z]+)0", r"\1o"), (r"0([A-Za-z]+)", r"o\1"), (r"([A-Za-z]+)0([A-Za-z]+)", r"\1o\2"),
    ("ler", "1er"), ("Ier", "1er"), ("1es", "les"),
]
WORD_RULES = {
    "Préfident": "Président", "Confeil": "Conseil", "Juftice": "Justice", "l'impreffion": "l'impression", "réfolu": "résolu", "meffage": "message", "meflage": "message",
    "indivifible": "indivisible", "ci-deffus": "ci-dessus", "ci-deflus": "ci-dessus", "fceau": "sceau", "préfent": "présent", "réfolution": "résolution", "fource": "source",
    "préfente": "présente", "claffe": "classe", "Laufanne": "Lausanne", "Miniftre": "Ministre", "befoin": "besoin", "Comiffion": "Commission", "auffi": "aussi",
    "prefcrite": "prescrite", "boiffon": "boisson", "boiffons": "boissons", "néceffaire": "nécessaire", "Affemblée": "Assemblée", "meffages": "messages", "Commiffion": "Commission",
    "fignatures": "signatures", "figné": "signé", "fignés": "signés", "fel": "sel", "fignée": "signée", "fcellé": "scellé", "prifonnier": "prisonnier", "prifonniers": "prisonniers",
    "néceffité": "nécessité", "Meffieurs": "Messieurs", "préfervatif": "préservatif", "Confeils": "Conseils", "€": "&", "mililaires": "militaires", "mililaire": "militaire",
}
LIGATURES = {"’": "'", "Œ": "OE", "œ": "oe", "Æ": "AE", "æ": "ae"}
STRIP_LEFT, STRIP_RIGHT = " |=+$£}{][*_:;.,", " |=+$£}{][*_"

# Dates.
MONTHS = ["janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre"]
REPUBLICAN_MONTHS = ["vendemiaire", "brumaire", "frimaire", "nivose", "pluviose", "ventose", "germinal", "floreal", "prairial", "messidor", "thermidor", "fructidor"]
MONTH_VARIANTS = {"may": 5, "aoust": 8, "decembr": 12}
SHORT_MONTHS = {"jer": 1, "7bre": 9, "8bre": 10, "9bre": 11, "10bre": 12, "xbre": 12}
ANNOUNCE = ["Ainsi adoptee", "Donnee", "Donne", "Fait"]
CHAMBERS = ["Grand Conseil", "Conseil d'Etat"]
BEFORE_DATE = ["le ", "ce "]
LABEL_MONTHS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]

# Places, with spellings that mean another one.
PLACES = [
    "sion", "lucerne", "lausanne", "berne", "gernsbach", "st-gall", "brigue", "zurich", "bex", "fribourg", "sierre", "genes", "st-maurice", "paris", "turin", "palais des tuileries",
    "palais de saint cloud", "bechenkowiski", "witepsk", "smolensk", "slawkovo", "wiazma", "ghjat", "mojaisk", "moscou", "borowsk", "roilskoe", "vereia", "molodetschno",
    "palais de l'elysee", "lutzen", "francfort", "loerrach", "bale", "thonon", "troyes", "geneve", "lons-le-saunier", "yverdon", "monthey", "bramois", "viege", "bonneville",
    "illarsaz", "chamoson", "martigny", "aigle", "verolliez", "aoste", "rome", "aarau", "posieux", "massongex", "ratisbonne", "vaumarcus", "copenhague", "neuchatel", "coire",
    "riddes", "brougg argovie", "vernayaz", "glarus",
]
PLACE_SPELLINGS = {"coirele": "coire", "paixberne": "berne", "precieufesion": "sion", "cirsion": "sion", "vconsion": "sion", "st maurice": "st-maurice", "st gall": "st-gall", "massongez": "massongex", "arau": "aarau"}
PLACE_LABELS = {"palais de l'elysee": "Palais de l'Elysée", "st-gall": "St-Gall", "st-maurice": "St-Maurice", "palais des tuileries": "Palais des Tuileries", "palais de saint cloud": "Palais de Saint Cloud", "lons-le-saunier": "Lons-le-Saunier", "brougg argovie": "Brougg Argovie", "bale": "Bâle", "geneve": "Genève", "genes": "Gênes", "viege": "Viège", "neuchatel": "Neuchâtel"}

# Titles: starts of blocks that are none, connectors, false starts.
NO_TITLE = [
    "le grand conseil", "le conseil", "republique", "liberte", "le departement", "ministere", "canton", "au nom", "la chambre", "administration", "departement",
    "une et indivisible", "de la republique", "ponts et chaussees", "helvetique", "empire", "ndeg", "egalite", "le comite", "le conseiller", "le grand-conseil", "l'administration",
    "lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche",
]
CONNECTORS = ["[a-z]+ant", "du", "des", "a", "aux", "au", "sur", "et", "au sujet de", "par", "relatif a", "relative a", "contre", "qui", "pour", "prononce par"]
END_CONNECTORS = ["le", "la", "les"]
FALSE_TITLES = ["en execution", "informe", "avise", "vu", "chers", "monsieur", "messieurs", "tres-honores", "nous", "rend public"]

# Printers.
PRINTER_HEADS = ["(?:l|i)mprimeri(?:e|s) (?:des citoyens )?", "imprim ", "imp(?: nat)? ", "imp et lith ", "tyopgraphie ", "typographia ", "imprime chez ", "imprime dans notre "]
PRINTERS = [
    "henri vincent", "emanuel hortin", "hignou", "antoine advocat", "andre fischer et luc vincent", "michel leroy", "luc sestie", "gauthier pere et fils", "hignou aine", "etienne ganioz",
    "calpini et holdermann", "emanuel vincent fils", "freres blanchard", "samuel delisle", "ch gruaz", "calpini-albertazzi", "l schmid", "marius olive", "a morand", "schmid et murmann",
    "louis advocat", "sylvain theubet", "vaney", "haller", "monaldi", "corbaz et robellaz", "pache", "p -v oursel", "p meyll", "delisle", "david rachor", "chr fischer", "ferdinand penon",
    "marc ducloux", "ganioz", "ceresole et panizza", "gay et steinbach", "p -a donnant", "edouard laederich", "ch steinbach", "corbaz et rouiller fils", "a larpin", "attinger",
    "rieder et simmen", "p dubois", "f aymon", "georges bridel", "dufour", "schmid", "k -j wyss", "vincent", "j schmid", "dulex-ansermoz", "michel vester", "gueffier", "coesnonpellerin",
    "gruner gessner", "joseph louis salzmann",
]
PRINTER_TITLES = ["imprimerie imperiale", "imprimerie nationale", "imprimerie des citoyens", "imprimerie de la republique", "imprimerie du gouvernement", "imprimerie de l'echo", "imprimerie de la nation suisse", "imprimerie roiale"]
PRINTER_SPELLINGS = {
    "art advocat": "antoine advocat", "antoine anvocat": "antoine advocat", "calpini-albertazzl": "calpini-albertazzi", "catpini-albertazzi": "calpini-albertazzi", "a abborat": "antoine advocat",
    "imprim nat": "imprimerie nationale", "imp nat": "imprimerie nationale", "henri em vincent": "henri vincent", "imprim national": "imprimerie nationale", "imprim nation": "imprimerie nationale",
    "imprim du gouvernement": "imprimerie du gouvernement", "ant advocat": "antoine advocat", "imprim du gouvern": "imprimerie du gouvernement", "s delisle": "samuel delisle",
    "calbini-albertazzi": "calpini-albertazzi", "a advocat": "antoine advocat", "emm vincent fils": "emanuel vincent fils", "l advocat": "louis advocat", "d rachor": "david rachor",
    "e laederich": "edouard laederich", "le citoyen coesnonpellerin": "coesnonpellerin",
}

# Signatures.
BEFORE_SIGNATURE = ["\n", r"\d\d\d\d ", "\nPar ", "\nL S "]
SIGNATORIES = [
    "conseiller d'etat", "grand baillif", "grand-baillif", "chef", "president", "conseiller national", "depute", "conseiller fédéral", "prince", "prefet", "general", "ministre", "eveque",
    "bourguemaitre", "vice-president", "colonel", "commissaire(?:s)? federa(?:ux|l)? dans le canton du valais", "vice-baillif", "lieutenant", "ingenieur", "forestier", "intendant",
    "1er vice-president", "sous-prefet",
]
SIGNATORY_EXTRAS = ["provisoire", "adjoint", "substitue", "cantonal", "en chef", "general"]
OF = ["du ", "des ", "de ", "d'"]
INSTITUTIONS = ["chancellerie", "departement", "comite", "conseil", "inspection", "commission"]
INSTITUTION_EXTRAS = ["federal(?:e)?", "national(?:e)?", "cantonal(?:e)?", "en chef"]
SECRETARIES = ["secretaire", "chancelier", "secretaires"]
TRANSITIONS = ["(?:\n| )charge du departement(?:(?: de| des)? [a-z']+)?", "(?:\n| )et de la legion d'honneur"]
SIGNED = ["CLS", "CL S", "L S", "signe"]
NO_NAMES = ["en son absence"]

# Categories.
CATEGORIES = [
    "Extrait", "Loi", "Decret", "Rapport", "Budget", "Publication", "Proclamation", "Instruction(?:s)?", "Taxe", "permis de sejour", "permis de chasse", "permis de peche", "certificat", "lettre",
    "Reglement", "Tractanda", "Concordat", "Ordonnance", "Supplement", "Appel", "Circulaire", "Arrete", "Signalement", "Etat de paye", "Ordre", "Proces verbal", "Etat sommaire", "Depouillement", "Registre",
]
CATEGORY_VERBS = {"decrete": "decret", "arrete": "arrete", "informe": "information", "fait ordre": "ordre", "ordonne": "ordre"}
CATEGORY_FORMS = {"instructions": "instruction"} | CATEGORY_VERBS
CATEGORY_LABELS = {"arrete": "Arrêté", "decret": "Décret", "proces verbal": "Procès verbal", "supplement": "Supplément", "reglement": "Règlement", "projet d'arrete": "Projet d'Arrêté", "depouillement": "Dépouillement", "projet de decret": "Projet de décret", "projet de reglement": "Projet de règlement", "ordonnent": "Ordre"}

# Topics by keyword: those that settle a topic, those that hint at one.
TOPIC_KEYWORDS = {
    "collecte": "charité", "vaccination": "vaccination", "epizootie": "épizooties", "ban": "ban", "fanfare": "fanfare", "forestier": "forêts", "regent": "école", "sage-femme": "sage-femmes",
    "chemin de fer": "chemin de fer", "correction du rhone": "Rhône", "incendie": "incendie", "baigneurs": "bains thermaux", "heimatlos": "heimatlosat", "heimatloses": "heimatlosat",
    "concours": "concours", "college": "enseignement supérieur", "lycee": "enseignement supérieur", "université": "enseignement supérieur", "surlangue": "épizooties",
    "fusion des communes": "fusion de communes", "poids et mesures": "poids et mesures", "systeme metrique": "poids et mesures", "heimatlosat": "heimatlosat", "inondations": "catastrophe",
    "sonderbund": "Sonderbund", "comite de martigny": "Comité de Martigny",
}
TOPIC_HINTS = {"maladie": "santé", "ecole": "école", "militaire": "affaires militaires", "finances": "affaires financières", "bains": "bains thermaux", "tribunal": "affaires judiciaires", "tribunaux": "affaires judiciaires"}
FORBIDDEN_TERMS = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre", "directoire", "exécutif", "sénat", "lucerne", "mousson", "ministre", "accepter", "résoudre", "déclarer", "législatif", "urgence"]

# Labels of manifests.
LANGUAGE_LABELS = {"f": "français", "a": "allemand", "t": "italien", "l": "latin"}
COTE_LABELS = {"cote": "Côte", "interet": "Intérêt", "compilation": "Compilation", "nombre_image": "Nombre d'images", "structure_vide": "Structure vide"}
DOCUMENT_LABELS = {"lieu": "Lieu", "categorie": "Type", "intitule": "Intitulé", "signataire_nom": "Signataire principal", "signataire_titre": "Fonction du signataire principal", "secretaire_nom": "Secrétaire signataire", "secretaire_titre": "Fonction du secrétaire signataire", "imprimeur": "Imprimeur", "sujet_1": "Sujet 1", "sujet_2": "Sujet 2", "sujet_3": "Sujet 3"}
IMAGE_LABELS = {"manuscrit": "Manuscrit", "texte_original_fr": "Texte français", "texte_original_la": "Texte latin", "texte_original_it": "Texte italien"}
