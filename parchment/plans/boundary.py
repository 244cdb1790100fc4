"""What needs a decoder of PDFs or pixels: interfaces to fill in, each with a default that says so.

The engine computes on what comes out of them. An implementation is registered under the name of its task and used by
mapInArrow over binaryFile rows, so that a library runs where the files are and holds a batch at a time.
"""

from __future__ import annotations

from abc import ABC, abstractmethod

from pyspark.sql import DataFrame


class PdfText(ABC):
    """The text layer of PDF files (path, content)."""

    @abstractmethod
    def page_texts(self, files: DataFrame) -> DataFrame:
        """(doc_id, page_no, source_text), texts stripped; pages without text have an empty one."""

    @abstractmethod
    def page_words(self, files: DataFrame) -> DataFrame:
        """(doc_id, page_no, word_ord, x0, y0, x1, y1, token, rect_w, rect_h) in the page's own units; geometry.scale_words() scales them."""


class Pixels(ABC):
    """Images out of files (path, content) and regions of them."""

    @abstractmethod
    def pages(self, files: DataFrame, dpi: int = 200) -> DataFrame:
        """(doc_id, page_no, image: PNG) of PDF files."""

    @abstractmethod
    def crops(self, files: DataFrame, boxes: DataFrame, dpi: int = 400) -> DataFrame:
        """(…, crop: PNG) of the boxes (doc_id, page_no, left, top, right, bottom) that geometry.crop_box() gives."""

    @abstractmethod
    def cleaned(self, images: DataFrame, denoise: bool = True, deskew: bool = True, threshold: bool = True, lines: bool = True) -> DataFrame:
        """images (…, image) in grey, without noise, upright by the angle of skew(), black and white, with lines of tables strengthened."""

    @abstractmethod
    def skew(self, images: DataFrame) -> DataFrame:
        """images with angle, by which their content is turned, in degrees."""

    @abstractmethod
    def drawn(self, images: DataFrame, overlays: DataFrame) -> DataFrame:
        """images with the boxes and labels that render.overlay() gives."""


class Missing:
    """Stands in where nothing is registered."""

    def __init__(self, task: str):
        self._task = task

    def __getattr__(self, name: str):
        raise NotImplementedError(f"{self._task}.{name} needs a decoder: register an implementation for {self._task!r}")


_REGISTERED: dict[str, object] = {}
TASKS = {"pdf_text": PdfText, "pixels": Pixels}


def register(task: str, implementation: PdfText | Pixels) -> None:
    if not isinstance(implementation, TASKS[task]):
        raise TypeError(f"{task} needs a {TASKS[task].__name__}")
    _REGISTERED[task] = implementation


def get(task: str):
    """The implementation registered for pdf_text or pixels, or one that fails with a clear error once it is used."""
    if task not in TASKS:
        raise ValueError(f"no task {task!r}; there are {', '.join(sorted(TASKS))}")
    return _REGISTERED.get(task) or Missing(task)
