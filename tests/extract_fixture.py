"""A tiny hand-made set of source extracts in the reference's file layout.

Covers: quoted separators, NULL tokens, 0/1 flags, a 3-decimal price, an
unused column, a null sales territory, a product without group and one with
two groups, an invoice without order, the same product ordered twice in one
order, and a customer whose category changes.
"""

import os

FILES = {
    "Application/Application.Countries.csv": [
        "CountryID;CountryName;Continent;Region;Unused",
        "1;Elbonia;Europe;East;x",
        '2;"Freedonia; North";Europe;West;y',
    ],
    "Application/Application.StateProvinces.csv": [
        "StateProvinceID;StateProvinceName;CountryID;SalesTerritory",
        "10;Upper;1;North",
        "11;Lower;2;NULL",
    ],
    "Application/Application.Cities.csv": [
        "CityID;CityName;StateProvinceID",
        "100;Alpha;10",
        "101;Beta;11",
        "102;Gamma;11",
    ],
    "Application/Application.People.csv": [
        "PersonID;FullName;IsSalesperson;LogonName",
        "1;Ann Seller;1;ann",
        "2;Bob Seller;1;bob",
        "3;Cy Clerk;0;cy",
    ],
    "Sales/Sales.CustomerCategories.csv": [
        "CustomerCategoryID;CustomerCategoryName",
        "1;Novelty Shop",
        "2;Wholesaler",
    ],
    "Sales/Sales.BuyingGroups.csv": [
        "BuyingGroupID;BuyingGroupName",
        "1;Group One",
        "2;Group Two",
    ],
    "Warehouse/Warehouse.Colors.csv": ["ColorID;ColorName", "1;Red"],
    "Warehouse/Warehouse.StockGroups.csv": [
        "StockGroupID;StockGroupName",
        "1;Toys",
        "2;Packaging",
    ],
    "Warehouse/Warehouse.StockItems.csv": [
        "StockItemID;StockItemName;ColorID;Brand;Size;UnitPrice",
        "1;Widget;1;Acme;S;10.005",
        "2;Gadget;NULL;NULL;M;20.00",
        "3;Doohickey;NULL;Acme;L;5.50",
    ],
    "Warehouse/Warehouse.StockItemStockGroups.csv": [
        "StockItemStockGroupID;StockItemID;StockGroupID",
        "1;1;2",
        "2;1;1",
        "3;2;2",
    ],
    "Sales/Sales.Customers.csv": [
        "CustomerID;CustomerName;CustomerCategoryID;BuyingGroupID;DeliveryCityID;AccountOpenedDate;StandardDiscountPercentage",
        "1;Head Office;1;1;100;2013-01-01;0.0000",
        "2;Corner Shop;1;NULL;101;2013-01-01 00:00:00;0.0000",
        "3;Big Store;2;2;102;NULL;NULL",
    ],
    "Sales/Sales.Orders.csv": [
        "OrderID;CustomerID;SalespersonPersonID;OrderDate;IsUndersupplyBackordered;BackorderOrderID",
        "1;1;1;2014-10-31;1;4",
        "2;1;2;2015-01-01;1;NULL",
        "3;2;1;2014-12-31;1;NULL",
        "4;1;1;2014-11-01;1;NULL",
    ],
    "Sales/Sales.OrderLines.csv": [
        "OrderLineID;OrderID;StockItemID;Quantity;PickedQuantity;UnitPrice;TaxRate",
        "1;1;1;10;10;10.01;15.000",
        "2;1;1;5;5;10.01;15.000",
        "3;2;2;4;4;20.00;15.000",
        "4;3;3;8;0;5.50;15.000",
        "5;4;2;2;2;20.00;15.000",
    ],
    "Sales/Sales.Invoices.csv": [
        "InvoiceID;CustomerID;OrderID;SalespersonPersonID;InvoiceDate",
        "1;1;1;1;2014-11-03",
        "2;1;2;2;2015-01-01",
        "3;3;NULL;2;2015-02-01",
    ],
    "Sales/Sales.InvoiceLines.csv": [
        "InvoiceLineID;InvoiceID;StockItemID;Quantity;UnitPrice;TaxRate;TaxAmount;LineProfit;ExtendedPrice",
        "1;1;1;12;10.01;15.000;18.02;50.00;138.14",
        "2;2;2;4;20.00;15.000;12.00;30.00;92.00",
        "3;3;3;1;5.50;15.000;0.83;2.00;6.33",
    ],
}


def write_fixture(root: str, files=FILES) -> str:
    for rel, lines in files.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as fh:
            fh.write("\n".join(lines) + "\n")
    return root
