"""Account numbers before further words, and very long dotted numbers."""
from clickforge.llm import pii


def found(text):
    return [(s["kind"], text[s["start"]:s["end"]]) for s in pii.find_personal_data(text)]


def test_an_account_number_before_a_word():
    de, gb = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    for text, number in ((f"IBAN {de} BIC COBADEFFXXX", de), (f"IBAN {de} In bank", de), (f"{gb} BY 3 May", gb),
                         ("DE89370400440532013000 2024-01-02", "DE89370400440532013000"), (f"REF AB12 3456 {de}", de), (f"{de} {gb}", de)):
        assert ("iban", number) in found(text), text
    assert [k for k, _ in found(f"{de} {gb}")] == ["iban", "iban"]
    assert found(f"{de}1") == found(f"x{de}") == found("DE89 3704 0044 0532 0130 0") == []


def test_an_account_number_of_an_unknown_country():
    body = "XY00ABCD1234567890"
    check = next(f"{k:02d}" for k in range(98) if pii.mod_97(f"XY{k:02d}{body[4:]}"))
    number = f"XY{check}{body[4:]}"
    assert ("iban", number) in found(f"account {number} a")


def test_zeros_in_a_dotted_number():
    text = "1.2." + "0" * 5000 + ".4"
    assert found(text) == [("ip", text)]
    assert found("1.2." + "0" * 5000 + "256.4") == []
