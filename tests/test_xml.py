"""The split XML reader gives the rows of the XML reader, whatever comments and character data hold."""

import random

import pytest

from lakeops.sources import files

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<FlexStatement>'


def both(spark, path):
    return [sorted((tuple(r) for r in files.read_positions_xml(spark, path, splittable=s).collect()), key=str) for s in (True, False)]


def test_comments_character_data_and_entities(spark, tmp_path):
    path = tmp_path / "a.xml"
    path.write_text(HEAD + '''<!-- <OpenPosition symbol="OLD" position="1"/> --><OpenPosition symbol="A&#233;B &#38; C &#x41;&quot;" position="2"/>
<!-- two <OpenPosition symbol="OLD2"/> <b/> <OpenPosition symbol="OLD3"/>
--><x><![CDATA[<OpenPosition symbol="CD"/> ]] > <!-- ]]><OpenPosition symbol='in"x' position='a --> b'></OpenPosition></x>
<OpenPositions symbol="no"/><OpenPosition symbol="l&lt;m" markPrice="1.5"/><!----><OpenPosition
 symbol="wide"
/></FlexStatement>''')
    got, expected = both(spark, str(path))
    assert got == expected
    assert [r[0] for r in got] == ['AéB & C A"', 'in"x', "l<m", "wide"]


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_xml_reader(spark, tmp_path, seed):
    """Files cut into small splits, so that comments and character data reach over them."""
    rng = random.Random(seed)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        for f in range(3):
            out = [HEAD]
            for i in range(120):
                one = f'<OpenPosition symbol="{f}-{i} &amp; &#{rng.randint(65, 900)};" position="{rng.choice(["-->", "]]>", "x", "&gt;"])}"/>'
                kind = rng.random()
                if kind < 0.15:
                    one = f"<!-- {one} {'<y>' * rng.randint(0, 200)} {one if rng.random() < 0.3 else ''} -->".replace('"-->"', '"x"')
                elif kind < 0.3:
                    one = f"<z><![CDATA[ {one} {'<!--' * rng.randint(0, 3)} {'w ' * rng.randint(0, 400)}]]></z>".replace('"]]>"', '"x"')
                out.append(one)
            (tmp_path / f"{f}.xml").write_text("\n".join([*out, "</FlexStatement>"]))
        got, expected = both(spark, str(tmp_path))
        assert got == expected and len(got) > 150
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
