"""Character sets and normalisation of transcriptions. The values are fixed: results depend on each of them."""

# Sets of special characters.
MEDIEVAL = (
    "", "ꝭ", "ꝵ", "᷑", "ꝰ", "̧", "̇", "̶", "̃", "̾", "ꝯ", "÷", "⁊", "ħ", "‸", "ł",
    "Ꝉ", "Ø", "ꝓ", "Ꝓ", "ꝑ", "Ꝑ", "¶", "ꝙ", "Ꝙ", "ꝗ", "ẜ", "⟦", "⟧",
)
COMBINING = (
    "ͣ", "ᷨ", "ͨ", "ͩ", "ͤ", "ᷫ", "ᷚ", "ͪ", "ͥ", "", "ᷜ", "ᷝ", "ͫ", "ᷠ", "ͦ", "ᷮ",
    "", "ͬ", "ᷤ", "ͭ", "ͧ", "ͮ", "ᷱ", "ͯ", "", "ᷦ",
)
SUPERSCRIPT = (
    "ᵃ", "ᵇ", "ᶜ", "ᵈ", "ᵉ", "ᶠ", "ᵍ", "ʰ", "ⁱ", "ʲ", "ᵏ", "ˡ", "ᵐ", "ⁿ", "ᵒ", "ᵖ",
    "𐞥", "ʳ", "ˢ", "ᵗ", "ᵘ", "ᵛ", "ʷ", "ˣ", "ʸ", "ᶻ", "⁰", "¹", "²", "³", "⁴", "⁵",
    "⁶", "⁷", "⁸", "⁹", "⁽", "⁾", "ᵃ́", "ᵉ́", "ⁱ́", "ᵒ́", "ᵘ́", "ᵃ̀", "ᵉ̀", "ⁱ̀", "ᵒ̀", "ᵘ̀",
    "ᵃ̈", "ᵉ̈", "ⁱ̈", "ᵒ̈", "ᵘ̈", "ᵃ̃", "ᵉ̃", "ⁱ̃", "ᵒ̃", "ᵘ̃",
)

# Characters and what replaces them, always and with the extended set.
BASE_NORMS = {
    "V": "U", "v": "u", "J": "I", "j": "i", "ſ": "s", "·": ".", "¬": "-", "‧": ".",
    "ē": "ẽ", "ā": "ã", "ī": "ĩ", "ō": "õ", "ū": "ũ", "̄": "̃", "í": "i", "İ": "I",
    "ı": "i", "ẏ": "y", "?": ":", "!": ":", ";": ":",
}
EXTENDED_NORMS = {
    "č": "c", "Č": "C", "ž": "z", "Ž": "Z", "̌": "", "ż": "z", "Ż": "Z", "ċ": "c",
    "Ċ": "C", "ṙ": "r", "ẛ": "s", "ṫ": "t", "̇": "",
}
