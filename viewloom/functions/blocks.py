"""Unicode blocks and common ideographs: fixed values."""

from __future__ import annotations

# Fixed values of Unicode 15: the first code point of each block, without its last hex digit, and the
# block's name; a number alone begins a gap. Controls are a block of their own.
_BLOCKS = """
0 Control character; 2 Basic Latin; 8 Latin-1 Supplement; 10 Latin Extended-A; 18 Latin Extended-B; 25 IPA
Extensions; 2B Spacing Modifier Letters; 30 Combining Diacritical Marks; 37 Greek and Coptic; 40 Cyrillic;
50 Cyrillic Supplement; 53 Armenian; 59 Hebrew; 60 Arabic; 70 Syriac; 75 Arabic Supplement; 78 Thaana; 7C
NKo; 80 Samaritan; 84 Mandaic; 86 Syriac Supplement; 87 Arabic Extended-B; 8A Arabic Extended-A; 90
Devanagari; 98 Bengali; A0 Gurmukhi; A8 Gujarati; B0 Oriya; B8 Tamil; C0 Telugu; C8 Kannada; D0 Malayalam;
D8 Sinhala; E0 Thai; E8 Lao; F0 Tibetan; 100 Myanmar; 10A Georgian; 110 Hangul Jamo; 120 Ethiopic; 138
Ethiopic Supplement; 13A Cherokee; 140 Unified Canadian Aboriginal Syllabics; 168 Ogham; 16A Runic; 170
Tagalog; 172 Hanunoo; 174 Buhid; 176 Tagbanwa; 178 Khmer; 180 Mongolian; 18B Unified Canadian Aboriginal
Syllabics Extended; 190 Limbu; 195 Tai Le; 198 New Tai Lue; 19E Khmer Symbols; 1A0 Buginese; 1A2 Tai Tham;
1AB Combining Diacritical Marks Extended; 1B0 Balinese; 1B8 Sundanese; 1BC Batak; 1C0 Lepcha; 1C5 Ol Chiki;
1C8 Cyrillic Extended-C; 1C9 Georgian Extended; 1CC Sundanese Supplement; 1CD Vedic Extensions; 1D0 Phonetic
Extensions; 1D8 Phonetic Extensions Supplement; 1DC Combining Diacritical Marks Supplement; 1E0 Latin
Extended Additional; 1F0 Greek Extended; 200 General Punctuation; 207 Superscripts and Subscripts; 20A
Currency Symbols; 20D Combining Diacritical Marks for Symbols; 210 Letterlike Symbols; 215 Number Forms; 219
Arrows; 220 Mathematical Operators; 230 Miscellaneous Technical; 240 Control Pictures; 244 Optical Character
Recognition; 246 Enclosed Alphanumerics; 250 Box Drawing; 258 Block Elements; 25A Geometric Shapes; 260
Miscellaneous Symbols; 270 Dingbats; 27C Miscellaneous Mathematical Symbols-A; 27F Supplemental Arrows-A;
280 Braille Patterns; 290 Supplemental Arrows-B; 298 Miscellaneous Mathematical Symbols-B; 2A0 Supplemental
Mathematical Operators; 2B0 Miscellaneous Symbols and Arrows; 2C0 Glagolitic; 2C6 Latin Extended-C; 2C8
Coptic; 2D0 Georgian Supplement; 2D3 Tifinagh; 2D8 Ethiopic Extended; 2DE Cyrillic Extended-A; 2E0
Supplemental Punctuation; 2E8 CJK Radicals Supplement; 2F0 Kangxi Radicals; 2FE; 2FF Ideographic Description
Characters; 300 CJK Symbols and Punctuation; 304 Hiragana; 30A Katakana; 310 Bopomofo; 313 Hangul
Compatibility Jamo; 319 Kanbun; 31A Bopomofo Extended; 31C CJK Strokes; 31F Katakana Phonetic Extensions;
320 Enclosed CJK Letters and Months; 330 CJK Compatibility; 340 CJK Unified Ideographs Extension A; 4DC
Yijing Hexagram Symbols; 4E0 CJK Unified Ideographs; A00 Yi Syllables; A49 Yi Radicals; A4D Lisu; A50 Vai;
A64 Cyrillic Extended-B; A6A Bamum; A70 Modifier Tone Letters; A72 Latin Extended-D; A80 Syloti Nagri; A83
Common Indic Number Forms; A84 Phags-pa; A88 Saurashtra; A8E Devanagari Extended; A90 Kayah Li; A93 Rejang;
A96 Hangul Jamo Extended-A; A98 Javanese; A9E Myanmar Extended-B; AA0 Cham; AA6 Myanmar Extended-A; AA8 Tai
Viet; AAE Meetei Mayek Extensions; AB0 Ethiopic Extended-A; AB3 Latin Extended-E; AB7 Cherokee Supplement;
ABC Meetei Mayek; AC0 Hangul Syllables; D7B Hangul Jamo Extended-B; D80 High Surrogates; DB8 High Private
Use Surrogates; DC0 Low Surrogates; E00 Private Use Area; F90 CJK Compatibility Ideographs; FB0 Alphabetic
Presentation Forms; FB5 Arabic Presentation Forms-A; FE0 Variation Selectors; FE1 Vertical Forms; FE2
Combining Half Marks; FE3 CJK Compatibility Forms; FE5 Small Form Variants; FE7 Arabic Presentation Forms-B;
FF0 Halfwidth and Fullwidth Forms; FFF Specials; 1000 Linear B Syllabary; 1008 Linear B Ideograms; 1010
Aegean Numbers; 1014 Ancient Greek Numbers; 1019 Ancient Symbols; 101D Phaistos Disc; 1020; 1028 Lycian;
102A Carian; 102E Coptic Epact Numbers; 1030 Old Italic; 1033 Gothic; 1035 Old Permic; 1038 Ugaritic; 103A
Old Persian; 103E; 1040 Deseret; 1045 Shavian; 1048 Osmanya; 104B Osage; 1050 Elbasan; 1053 Caucasian
Albanian; 1057 Vithkuqi; 105C; 1060 Linear A; 1078 Latin Extended-F; 107C; 1080 Cypriot Syllabary; 1084
Imperial Aramaic; 1086 Palmyrene; 1088 Nabataean; 108B; 108E Hatran; 1090 Phoenician; 1092 Lydian; 1094;
1098 Meroitic Hieroglyphs; 109A Meroitic Cursive; 10A0 Kharoshthi; 10A6 Old South Arabian; 10A8 Old North
Arabian; 10AA; 10AC Manichaean; 10B0 Avestan; 10B4 Inscriptional Parthian; 10B6 Inscriptional Pahlavi; 10B8
Psalter Pahlavi; 10BB; 10C0 Old Turkic; 10C5; 10C8 Old Hungarian; 10D0 Hanifi Rohingya; 10D4; 10E6 Rumi
Numeral Symbols; 10E8 Yezidi; 10EC Arabic Extended-C; 10F0 Old Sogdian; 10F3 Sogdian; 10F7 Old Uyghur; 10FB
Chorasmian; 10FE Elymaic; 1100 Brahmi; 1108 Kaithi; 110D Sora Sompeng; 1110 Chakma; 1115 Mahajani; 1118
Sharada; 111E Sinhala Archaic Numbers; 1120 Khojki; 1125; 1128 Multani; 112B Khudawadi; 1130 Grantha; 1138;
1140 Newa; 1148 Tirhuta; 114E; 1158 Siddham; 1160 Modi; 1166 Mongolian Supplement; 1168 Takri; 116D; 1170
Ahom; 1175; 1180 Dogra; 1185; 118A Warang Citi; 1190 Dives Akuru; 1196; 119A Nandinagari; 11A0 Zanabazar
Square; 11A5 Soyombo; 11AB Unified Canadian Aboriginal Syllabics Extended-A; 11AC Pau Cin Hau; 11B0
Devanagari Extended-A; 11B6; 11C0 Bhaiksuki; 11C7 Marchen; 11CC; 11D0 Masaram Gondi; 11D6 Gunjala Gondi;
11DB; 11EE Makasar; 11F0 Kawi; 11F6; 11FB Lisu Supplement; 11FC Tamil Supplement; 1200 Cuneiform; 1240
Cuneiform Numbers and Punctuation; 1248 Early Dynastic Cuneiform; 1255; 12F9 Cypro-Minoan; 1300 Egyptian
Hieroglyphs; 1343 Egyptian Hieroglyph Format Controls; 1346; 1440 Anatolian Hieroglyphs; 1468; 1680 Bamum
Supplement; 16A4 Mro; 16A7 Tangsa; 16AD Bassa Vah; 16B0 Pahawh Hmong; 16B9; 16E4 Medefaidrin; 16EA; 16F0
Miao; 16FA; 16FE Ideographic Symbols and Punctuation; 1700 Tangut; 1880 Tangut Components; 18B0 Khitan Small
Script; 18D0 Tangut Supplement; 18D8; 1AFF Kana Extended-B; 1B00 Kana Supplement; 1B10 Kana Extended-A; 1B13
Small Kana Extension; 1B17 Nushu; 1B30; 1BC0 Duployan; 1BCA Shorthand Format Controls; 1BCB; 1CF0 Znamenny
Musical Notation; 1CFD; 1D00 Byzantine Musical Symbols; 1D10 Musical Symbols; 1D20 Ancient Greek Musical
Notation; 1D25; 1D2C Kaktovik Numerals; 1D2E Mayan Numerals; 1D30 Tai Xuan Jing Symbols; 1D36 Counting Rod
Numerals; 1D38; 1D40 Mathematical Alphanumeric Symbols; 1D80 Sutton SignWriting; 1DAB; 1DF0 Latin
Extended-G; 1E00 Glagolitic Supplement; 1E03 Cyrillic Extended-D; 1E09; 1E10 Nyiakeng Puachue Hmong; 1E15;
1E29 Toto; 1E2C Wancho; 1E30; 1E4D Nag Mundari; 1E50; 1E7E Ethiopic Extended-B; 1E80 Mende Kikakui; 1E8E;
1E90 Adlam; 1E96; 1EC7 Indic Siyaq Numbers; 1ECC; 1ED0 Ottoman Siyaq Numbers; 1ED5; 1EE0 Arabic Mathematical
Alphabetic Symbols; 1EF0; 1F00 Mahjong Tiles; 1F03 Domino Tiles; 1F0A Playing Cards; 1F10 Enclosed
Alphanumeric Supplement; 1F20 Enclosed Ideographic Supplement; 1F30 Miscellaneous Symbols and Pictographs;
1F60 Emoticons; 1F65 Ornamental Dingbats; 1F68 Transport and Map Symbols; 1F70 Alchemical Symbols; 1F78
Geometric Shapes Extended; 1F80 Supplemental Arrows-C; 1F90 Supplemental Symbols and Pictographs; 1FA0 Chess
Symbols; 1FA7 Symbols and Pictographs Extended-A; 1FB0 Symbols for Legacy Computing; 1FC0; 2000 CJK Unified
Ideographs Extension B; 2A6E; 2A70 CJK Unified Ideographs Extension C; 2B74 CJK Unified Ideographs Extension
D; 2B82 CJK Unified Ideographs Extension E; 2CEB CJK Unified Ideographs Extension F; 2EBF; 2F80 CJK
Compatibility Ideographs Supplement; 2FA2; 3000 CJK Unified Ideographs Extension G; 3135 CJK Unified
Ideographs Extension H; 323B; E000 Tags; E008; E010 Variation Selectors Supplement; E01F; F000 Supplementary
Private Use Area-A; 10000 Supplementary Private Use Area-B; 11000
"""

#: (first code point, code point after the last, name) of each block.
BLOCKS: list[tuple[int, int, str]] = []


def _read() -> None:
    entries = [e.strip().partition(" ") for e in _BLOCKS.replace("\n", " ").split(";")]
    for (first, _, name), (after, _, _) in zip(entries, entries[1:]):
        if name:
            BLOCKS.append((int(first, 16) << 4, int(after, 16) << 4, name))


_read()

# The ideographs that are common in Chinese, Japanese or Korean writing.
COMMON_IDEOGRAPHS = (
    "一七万三上下不与专且世业东两严个中为主么义之九也习书了争事二于五些交产京亲人什今从他代以们件价任休众会传但位低住体何作你"
    "使例便保信候值做儿元先光克党入全八公六共关其具养内円再写军农决况准几出分切划列则利别到制前力办加务动劳包化北区十千午半华"
    "单南即却厂历压原去县参又及友反发取受变口只叫可史右号各合同名后向听员周命和品响商器四回因团国图圆國土在地场型基增声处备复"
    "外多大天太头女她好如始委子存学學它安完定实家容对导将小少就局层展属山川工左己已市布带常干平年并广应府度建开式引张强当形影"
    "往很律後得心必志快思性总情想意感成我或战所手才打技把报拉持指按据接提支收改放政效教数整文斗料断斯新方族无日时明易是時更書"
    "最月有期木本术机权条来東极构林果查标校样根格次正此步段母毎每比毛民气気水求江没油治法活派流济海消深清温满火点热然照父片物"
    "特状率王现理生用由电男界白百的目直相省看真眼着知石矿研确示社离种科积程究空立第等算管米类精系素红约级线组细织经结给统维置"
    "美群老者而联聞育能自至般色节花萬行表被装西要見见观规角解話語読计认议记许论设证识话该说调象质资走起越路身車车转较边达过运"
    "近还这进连适选通速造道那部都酸采里重量金铁長长間门问间队阶际院除难集雨電需青非面革音须领题风飞食马验高龙"
)
