import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def write_image(spark):
    """Write a numpy image (grey or RGB) with the JVM's codecs."""
    jvm = spark._jvm

    def write(path: str, array, fmt: str) -> None:
        height, width = array.shape[:2]
        gray = array.ndim == 2
        image = jvm.java.awt.image.BufferedImage(width, height, 10 if gray else 1)
        if gray:
            raster = image.getRaster()
            for y in range(height):
                for x in range(width):
                    raster.setSample(x, y, 0, int(array[y, x]))
        else:
            for y in range(height):
                for x in range(width):
                    r, g, b = (int(v) for v in array[y, x])
                    image.setRGB(x, y, (r << 16) | (g << 8) | b)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        assert jvm.javax.imageio.ImageIO.write(image, fmt, jvm.java.io.File(path))

    return write


@pytest.fixture(scope="session")
def raw_tree(tmp_path_factory, write_image):
    """Class directories with a normal class, a hidden file, odd names and a damaged image."""
    import numpy as np

    rng = np.random.default_rng(7)
    root = tmp_path_factory.mktemp("raw")
    for k, folder in enumerate(["_NORMAL T1", "Glioma T1C+", "Glioma T2", "007"]):
        for i in range(12):
            image = np.zeros((12, 12), int)
            image[2:10, 2:10] = rng.integers(60, 120, (8, 8)) + 30 * k
            image[4:6, 4 + k : 6 + k] = 250
            name = {0: "a b", 1: "a%20b", 2: "plus+sign"}.get(i, f"img_{i}")
            write_image(f"{root}/{folder}/{name}.{'PNG' if i == 3 else 'png'}", image, "png")
    write_image(f"{root}/Glioma T2/colour.png", rng.integers(0, 256, (9, 7, 3)), "png")
    write_image(f"{root}/Glioma T2/deep/photo.jpg", rng.integers(0, 256, (8, 8)), "jpg")
    for name in ("007/.hidden.png", "007/Thumbs.db", "007/broken.jpg", ".cache/x.png"):
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"not an image")
    return str(root)
