"""The page stage with stand-in engines."""

from vellumine.operators import pages


def engines():
    """Made inside a function, so that they are sent to the workers by value."""

    class Bytes:
        def load(self, content, path):
            if not content:
                raise ValueError("no content")
            return content.decode()

    class Lines:
        def process(self, image):
            return [(line, (0, i, 10, i + 1)) for i, line in enumerate(image.split("\n"))]

    class Upper:
        def run_blocks(self, blocks):
            if "fail" in blocks:
                raise RuntimeError("fail")
            return [b.upper() for b in blocks]

    return Bytes, Lines, Upper


def test_stage(spark):
    files = spark.createDataFrame([("a", b"one\n \ntwo"), ("b", b""), ("c", b"x\nfail\ny"), ("d", b" ")], "path string, content binary").coalesce(1)
    got = {r["path"]: r for r in pages.page_texts(pages.read_pages(files, *engines(), batch=2)).collect()}
    assert got["a"]["ocr_text"] == "ONE\n\nTWO" and (got["a"]["n_blocks"], got["a"]["n_blocks_kept"]) == (3, 2)
    assert got["b"]["status"] == "error" and "no content" in got["b"]["error"]
    assert got["c"]["ocr_text"] == "X\n\nY" and got["d"]["status"] == "empty"


def test_classification_from_second_reading(spark):
    df = spark.createDataFrame([(["head", "body"], "Klasse 96 g"), (["Klasse 8", "b"], "Klasse 9"), ([], "Klasse 9"), (["h"], None)], "blocks array<string>, again string")
    got = [r["blocks"] for r in pages.with_classification(df, "again").select("blocks").collect()]
    assert got == [["Klasse 96 g\nhead", "body"], ["Klasse 8", "b"], [], ["h"]]
