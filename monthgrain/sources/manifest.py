"""Which files arrive each month, and what their columns need when cleaned."""

from __future__ import annotations

from dataclasses import dataclass

BANK = "bank"
CALLS = "calls"


@dataclass(frozen=True)
class Source:
    """One monthly file.

    ``keep`` names columns that stay text when cleaned, ``dates`` those read as dates.
    ``required`` are columns whose nulls are counted when cleaned. ``unique`` says that a
    customer has one row a month, which cleaning checks.
    """

    name: str
    group: str = BANK
    file_stem: str = ""
    sep: str = "|"
    keep: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    unique: bool = False

    def file_name(self, snapshot: str) -> str:
        """``<stem>_<yyyyMM>``, with ``.csv`` for comma-separated files and ``.txt`` else."""
        ending = "csv" if self.sep == "," else "txt"
        return f"{self.file_stem or self.name}_{snapshot}.{ending}"

    @property
    def raw_table(self) -> str:
        return f"{self.group}_{self.name}_raw"

    @property
    def clean_table(self) -> str:
        return f"{self.group}_{self.name}"


# The eight open dates of the product-holding table, first and last per product.
OPEN_DATES = (
    "sfstopn",
    "slstopn",
    "dfstopn",
    "dlstopn",
    "gfstopn",
    "glstopn",
    "cfstopn",
    "clstopn",
)

_ACCOUNT_IDS = ("rekening", "cifno_15", "cifno_01")

# The monthly files, their separators, and the columns that are not numbers.
SOURCES = (
    Source("axa_avr", keep=_ACCOUNT_IDS),
    Source("axa_cust_cd", keep=_ACCOUNT_IDS),
    Source("axa_cust_demo", keep=_ACCOUNT_IDS),
    Source("axa_tran_allper_cd", keep=_ACCOUNT_IDS),
    Source("axa_tran_allper_db", keep=_ACCOUNT_IDS),
    Source("axa_tran_net", keep=("cif", *_ACCOUNT_IDS), unique=True),
    Source("cc_type_cnt", keep=_ACCOUNT_IDS),
    Source("cif_acct_mapping", keep=_ACCOUNT_IDS),
    Source("cifsumm", keep=_ACCOUNT_IDS, dates=("mxdt", "mndt"), unique=True),
    Source("cust_zipcode_mapping", keep=_ACCOUNT_IDS),
    Source("dc_type_cnt", keep=_ACCOUNT_IDS),
    Source("debitcard_trx_edc_cif", keep=_ACCOUNT_IDS, unique=True),
    Source("master_filter", keep=_ACCOUNT_IDS),
    Source("master_filter_consent", keep=_ACCOUNT_IDS),
    Source("phsumm", keep=_ACCOUNT_IDS, dates=OPEN_DATES, unique=True),
    Source("qris_trx_edc_cif", keep=_ACCOUNT_IDS),
    Source("trx_outflow", keep=("cifno_pengirim", "rekening_pengirim", *_ACCOUNT_IDS)),
    Source(
        "trx_outflow_payment_purchase",
        keep=("customer_no", "transaction_type", *_ACCOUNT_IDS),
        required=("transaction_type",),
    ),
    Source("all_status", CALLS, "ALL_STATUS", ","),
    Source("tso", CALLS, "TSO", "\t"),
    Source("call_tracking", CALLS, "call_tracking_savings", ","),
)
